"""Phrase collocations from FM-indexes over word ids, one per shard, summed across shards.

1. Words are counted per language. Those of at least `least` occurrences set bits in a bitmap of fixed size.
2. Tasks read the texts again and cut them into shards of about SHARD_WORDS words of one language. Everything that no
   phrase can hold (rarer words, and words without a neighbour) becomes a break. A shard is kept as a bidirectional
   index: the Burrows-Wheeler transforms of its words and of its words reversed, with the words' hashes and texts.
3. A phrase is an interval of each transform. All intervals of one word are extended to the left, which counts every
   pair. Sums over the shards, in a table of 2^PAIR_BITS counters that is spread over tasks, tell which pairs may be
   frequent; these set bits in a bitmap of their own.
4. Such pairs are extended to the right word by word, up to `longest`. Before each step the phrases so far are summed and
   marked in the same way, so only phrases are extended whose parts may all be frequent. Sums over shards of what has
   its bits, cut at `least`, are the exact counts of all phrases; they travel packed by ranges of hashes.
5. Cuts are looked up in these counts and scored; a phrase goes if an extension to the left or right is as frequent.

Suffixes are sorted by `longest` words and no further: that is as deep as intervals are ever followed. The bitmaps only
save work, a wrong bit never changes a count, so their size does not depend on the corpus. Words are 64-bit hashes until
the end; two words of one hash in the result raise an error.

Nulls: a null text is empty, a null language is `und`. Repeated rows count as often as they are there. A text is never
cut within a piece; a piece longer than a shard makes that shard longer. Without words there are no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, Words, bounded_batches, few_rows, give_back, mix, written

#: Marks that end a piece; words end at these, at spaces and at tabs.
PIECE_MARKS = b".,;:!?\n\x0b\x0c\r"
LEAST, LONGEST, TOP, SCALE = 100, 5, 2000, 1000
SHARD_WORDS, BUFFER_WORDS, COUNT_WORDS, COMBINED_ROWS = 500_000, 1_500_000, 1_000_000, 400_000
#: Bits of a bitmap, and of a block of it.
BITS, BLOCK_BITS = 1 << 26, 1 << 16
#: Bits of a pair's hash that choose its counter, and those of them within a table of one task.
PAIR_BITS, TABLE_BITS = 32, 22
#: Ranges of hashes that phrases are summed in; more where a range would hold more than about COMBINED_ROWS phrases.
RANGES = 64
BROADCAST_ROWS = 500_000

_MARK = np.isin(np.arange(256), list(PIECE_MARKS))
_BREAK = _MARK | np.isin(np.arange(256), [0x20, 0x09])


# --- words of a text -----------------------------------------------------------------------------------------

def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(language, UTF-8 of texts with A-Z in lower case) for runs of about SLICE_BYTES."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
        if text:
            texts.setdefault(lang, []).append(text.lower())
    for lang, all_of in texts.items():
        run, size = [], 0
        for text in all_of:
            if run and size + len(text) > SLICE_BYTES:
                yield lang, run
                run, size = [], 0
            run.append(text)
            size += len(text)
        yield lang, run


def hashed_words(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their hashes (never 0), and whether each continues the piece of the word before it."""
    words = Words(texts, _BREAK)
    pieces = np.cumsum(_MARK[words.buffer])[words.start]
    joined = np.zeros(len(words.start), bool)
    joined[1:] = (words.doc[1:] == words.doc[:-1]) & (pieces[1:] == pieces[:-1])
    return words, np.maximum(words.hashes(), 1), joined


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, h, n): occurrences of every word; with h null, of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                h, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(h) + 1)), pa.array([*h.view(np.int64).tolist(), None], pa.int64()),
                                                  pa.array([*n.tolist(), int(n.sum())], pa.int64())], names=["lang", "h", "n"])
            held.clear()
            give_back()

        for batch in batches:
            for lang, texts in by_language(batch):
                h = hashed_words(texts)[1]
                if len(h):
                    held.setdefault(lang, []).append(h)
                    size += len(h)
            if size > COUNT_WORDS:
                yield from counted()
                size = 0
        yield from counted()

    return docs.select("lang", "text").mapInArrow(run, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n"))


# --- bitmaps -------------------------------------------------------------------------------------------------

def hash_of(lang: str, *words: np.ndarray) -> np.ndarray:
    """One hash of the language and words in a row."""
    h = np.full(len(words[0]), int.from_bytes(sha256(lang.encode()).digest()[:8], "big"), np.uint64)
    for w in words:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of all rows (key: hash as bigint); the driver gets BITS bits, whatever the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None
        for batch in batches:
            if bits is None:
                bits = np.zeros(BITS, bool)
            bits[batch.column(0).to_numpy(zero_copy_only=False) & (BITS - 1)] = True
        if bits is not None:
            blocks = bits.reshape(-1, BLOCK_BITS)
            set_ = np.flatnonzero(blocks.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(set_, pa.int64()), pa.array([np.packbits(b).tobytes() for b in blocks[set_]], pa.binary())], names=["block", "bits"])

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        both = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in part["bits"]])
        return pd.DataFrame({"block": [part["block"].iloc[0]], "bits": [both.tobytes()]})

    out = np.zeros((BITS // BLOCK_BITS, BLOCK_BITS // 8), np.uint8)
    parts = keys.mapInArrow(run, "block bigint, bits binary")
    for row in parts.groupBy("block").applyInPandas(merged, "block bigint, bits binary").toLocalIterator():
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def word_keys(words: DataFrame) -> DataFrame:
    """(key) of words (lang, h)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            code, h = langs.indices.to_numpy(zero_copy_only=False), batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(hash_of(lang, h[code == i]).view(np.int64))], names=["key"])

    return words.select("lang", "h").mapInArrow(run, "key bigint")


def has_bit(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = (key & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


# --- index ---------------------------------------------------------------------------------------------------

def suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of `ids` sorted by what follows them, up to the next 0, at least `depth` symbols deep. `ids` ends with 0."""
    ends = ids == 0
    m, n = int(ends.sum()), len(ids)
    symbol = np.where(ends, np.cumsum(ends) - 1, ids.astype(np.int64) + m - 1)  # every break is a symbol of its own
    top = int(symbol.max()) + 1
    reach = 3 if top < 1 << 20 else 2
    key = np.zeros(n, np.int64)
    for k in range(reach):
        key *= top
        key[:n - k] += symbol[k:]
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    open_ = np.flatnonzero(~fresh | ~np.concatenate([fresh[1:], [True]]))
    group = start[open_]
    while reach < depth and len(open_):
        place = order[open_]
        key = group * n + rank[place + reach]
        by = np.argsort(key, kind="stable")
        place, key = place[by], key[by]
        order[open_] = place
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(fresh, open_, 0))
        rank[place] = group
        more = ~fresh | ~np.concatenate([fresh[1:], [True]])
        open_, group = open_[more], group[more]
        reach *= 2
    return order


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each place, in the order of the places."""
    return ids[suffix_order(ids, depth) - 1]


class Index:
    """Bidirectional FM-index of word ids 1, 2, ... with breaks 0, from both transforms; intervals are vectors of
    (first row in the forward order, first row in the backward order, size)."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, words: int):
        self.sides = []
        count = np.bincount(forward, minlength=words + 1)
        self.first, self.count = np.cumsum(count) - count, count
        for rows in (forward, backward):
            jump = np.empty(len(rows), np.int64)
            jump[np.argsort(rows, kind="stable")] = np.arange(len(rows))
            self.sides.append((rows, jump))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.first[1:], self.first[1:], self.count[1:]

    def _extend(self, side: int, low: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        rows, jump = self.sides[side]
        begin = np.cumsum(size) - size
        which = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(which)) + (low - begin)[which]
        symbol = rows[at].astype(np.int64)
        key = which * (len(self.count) + 1) + symbol
        by = np.argsort(key, kind="stable")
        key = key[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        amount = np.diff(np.append(first, len(key)))
        of, word = which[by[first]], symbol[by[first]]
        # Rows of smaller symbols come first in the other order.
        after = other[of] + first - begin[of]
        real = word > 0
        return of[real], word[real], jump[at[by[first]]][real], after[real], amount[real]

    def left(self, low: np.ndarray, back: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, word before it, low, back, size) of all extensions to the left."""
        return self._extend(0, low, back, size)

    def right(self, low: np.ndarray, back: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, word after it, low, back, size) of all extensions to the right."""
        of, word, back, low, size = self._extend(1, back, low, size)
        return of, word, low, back, size


_SHARD = "lang string, hashes binary, texts array<string>, forward binary, backward binary, wide boolean"


class _Buffer:
    """Words of one language that wait for their shard."""

    def __init__(self, lang: str):
        self.lang, self.parts, self.size = lang, [], 0
        self.known, self.texts = np.zeros(0, np.uint64), {}

    def add(self, words: Words, h: np.ndarray, joined: np.ndarray, frequent: np.ndarray) -> None:
        link = np.zeros(len(h) + 1, bool)
        link[1:-1] = joined[1:] & frequent[1:] & frequent[:-1]
        kept = np.flatnonzero(frequent & (link[:-1] | link[1:]))
        if not len(kept):
            return
        breaks = ~link[kept]
        at = np.arange(len(kept)) + np.cumsum(breaks)
        ids = np.zeros(len(kept) + int(breaks.sum()), np.uint64)
        ids[at] = h[kept]
        self.parts.append(ids)
        self.size += len(ids)
        distinct, first = np.unique(h[kept], return_index=True)
        new = ~np.isin(distinct, self.known)
        for value, i in zip(distinct[new].tolist(), kept[first[new]].tolist(), strict=True):
            self.texts[value] = words.buffer[words.start[i]:words.end[i]].tobytes()
        self.known = np.union1d(self.known, distinct)

    def shard(self, depth: int) -> pa.RecordBatch:
        hashes = np.concatenate([*self.parts, np.zeros(1, np.uint64)])
        ids = np.where(hashes == 0, 0, np.searchsorted(self.known, hashes) + 1)
        kind = np.uint32 if len(self.known) >= 1 << 16 else np.uint16
        binary = [self.known.tobytes(), transform(ids, depth).astype(kind).tobytes(), transform(ids[::-1].copy(), depth).astype(kind).tobytes()]
        texts = [self.texts[h].decode("utf-8", "replace") for h in self.known.tolist()]
        return pa.RecordBatch.from_arrays([pa.array([self.lang]), pa.array(binary[:1], pa.binary()), pa.array([texts], pa.list_(pa.string())), pa.array(binary[1:2], pa.binary()),
                                           pa.array(binary[2:], pa.binary()), pa.array([kind is np.uint32])], names=["lang", "hashes", "texts", "forward", "backward", "wide"])


def build_shards(docs: DataFrame, frequent: np.ndarray, depth: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Indexes of all texts; `frequent` is the bitmap of the words that phrases may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers: dict[str, _Buffer] = {}
        for batch in batches:
            for lang, texts in by_language(batch):
                words, h, joined = hashed_words(texts)
                buffers.setdefault(lang, _Buffer(lang)).add(words, h, joined, has_bit(shared.value, hash_of(lang, h)))
                if buffers[lang].size >= shard_words:
                    yield buffers.pop(lang).shard(depth)
                    give_back()
                while sum(b.size for b in buffers.values()) > BUFFER_WORDS:
                    yield buffers.pop(max(buffers, key=lambda name: buffers[name].size)).shard(depth)
        while buffers:
            _, buffer = buffers.popitem()
            if buffer.size:
                yield buffer.shard(depth)
        give_back()

    return docs.select("lang", "text").mapInArrow(run, _SHARD)


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, Index]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("lang", "hashes", "forward", "backward", "wide")}
            kind, hashes = np.uint32 if row["wide"] else np.uint16, np.frombuffer(row["hashes"], np.uint64)
            yield row["lang"], hashes, Index(np.frombuffer(row["forward"], kind), np.frombuffer(row["backward"], kind), len(hashes))
            del row, hashes
            give_back()


def _over_shards(shards: DataFrame, function: Callable, schema: str) -> DataFrame:
    return shards.select("lang", "hashes", "forward", "backward", "wide").mapInArrow(function, schema)


def pack_counts(key: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending keys of up to 24 bits and their counts in about two bytes each: differences and counts, byte plane by byte plane."""
    planes = [np.diff(key, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T[:3], n.astype("<u2").view(np.uint8).reshape(-1, 2).T]
    return zstandard.ZstdCompressor(1).compress(np.concatenate(planes).tobytes())


def unpack_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(5, -1).astype(np.uint32)
    return np.cumsum(planes[0] | planes[1] << 8 | planes[2] << 16), planes[3] | planes[4] << 8


def _extended(lang: str, hashes: np.ndarray, index: Index, bits: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, hashes of phrases, counts) of 2, 3, ... words in an index; `bits` has a bitmap per width, from 2 on.

    Words are extended to the left to pairs, phrases to the right from then on, as long as the bitmap of their width has
    them and their last words. Phrases one word longer than the bitmaps tell come last, all of them.
    """
    of, word, low, back, size = index.left(*index.words())
    phrase = np.stack([hashes[word - 1], hashes[of]], axis=1)
    for width, known in enumerate(bits, 2):
        keep = has_bit(known, hash_of(lang, *phrase.T))
        phrase, low, back, size = phrase[keep], low[keep], back[keep], size[keep]
        yield width, phrase, size
        of, word, low, back, size = index.right(low, back, size)
        phrase = np.concatenate([phrase[of], hashes[word - 1][:, None]], axis=1)
        keep = has_bit(known, hash_of(lang, *phrase[:, 1:].T))
        phrase, low, back, size = phrase[keep], low[keep], back[keep], size[keep]
    yield len(bits) + 2, phrase, size


def frequent_keys(shards: DataFrame, least: int, bits: list[np.ndarray]) -> DataFrame:
    """(key) of all phrases of len(bits) + 2 words of at least `least` occurrences, and of some others.

    Their hashes are cut to PAIR_BITS; counts of equal ones are summed in tables of 2^TABLE_BITS counters, one range of
    hashes after the other. A phrase that shares its counter may pass with too few occurrences, none is lost.
    """
    shared = shards.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, hashes, index in _indexes(batches):
            for _, phrase, size in _extended(lang, hashes, index, shared.value):
                pass
            if not len(size):
                continue
            key = hash_of(lang, *phrase.T) & np.uint64((1 << PAIR_BITS) - 1)
            by = np.argsort(key)
            key, first = np.unique(key[by], return_index=True)
            n = np.minimum(np.add.reduceat(np.minimum(size[by], least), first), 1 << 15)
            part, low = (key >> np.uint64(TABLE_BITS)).astype(np.int64), (key & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
            parts, at = np.unique(part, return_index=True)
            ends = np.append(at[1:], len(part))
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array([pack_counts(low[i:j], n[i:j]) for i, j in zip(at, ends, strict=True)], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table = None, np.zeros(1 << TABLE_BITS, np.uint32)

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(table >= least) + (now << TABLE_BITS))], names=["key"])

        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                if part != now:
                    if now is not None:
                        yield passed()
                        table[:] = 0
                    now = part
                key, n = unpack_counts(data)
                table[key] += n
        if now is not None:
            yield passed()

    blocks = _over_shards(shards, run, "part bigint, counts binary")
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(add, "key bigint")


class _Sums:
    """Counts of phrases of the shards that a task has read, up to about COMBINED_ROWS of them."""

    def __init__(self):
        self.parts: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        self.rows = 0

    def add(self, lang: str, phrases: np.ndarray, n: np.ndarray) -> None:
        self.parts.setdefault((lang, phrases.shape[1]), []).append((phrases, n))
        self.rows += len(n)

    def combine(self) -> None:
        for (lang, width), parts in self.parts.items():
            if len(parts) > 1:
                rows = np.ascontiguousarray(np.concatenate([p for p, _ in parts]))
                _, first, group = np.unique(rows.view(f"V{8 * width}").reshape(-1), return_index=True, return_inverse=True)
                total = np.bincount(group, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
                self.parts[lang, width] = [(rows[first], total)]
        self.rows = sum(len(n) for parts in self.parts.values() for _, n in parts)

    def blocks(self, ranges: int) -> Iterator[pa.RecordBatch]:
        """What was summed, as one row of packed phrases and counts per language, width and range of hashes; it is empty then."""
        for (lang, width), parts in self.parts.items():
            for phrases, n in parts:
                part = ((hash_of(lang, *phrases.T) >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
                by = np.argsort(part, kind="stable")
                part, phrases, n = part[by], phrases[by], n[by].astype(np.int64)
                found, at = np.unique(part, return_index=True)
                spans = list(zip(at, np.append(at[1:], len(part)), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([lang] * len(found), pa.string()), pa.array([width] * len(found), pa.int32()),
                                                  pa.array([phrases[i:j].tobytes() for i, j in spans], pa.binary()), pa.array([n[i:j].tobytes() for i, j in spans], pa.binary())],
                                                 names=["part", "lang", "width", "phrases", "n"])
        self.parts, self.rows = {}, 0

    def taken(self, least: int) -> Iterator[pa.RecordBatch]:
        """Phrases of at least `least` occurrences; nothing is left then."""
        self.combine()
        for (lang, width), parts in self.parts.items():
            for phrases, n in parts:
                phrases, n = phrases[n >= least], n[n >= least]
                flat = pa.array(phrases.reshape(-1).view(np.int64))
                grams = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), grams, pa.array(n)], names=["lang", "g", "a"])
        self.parts, self.rows = {}, 0


def phrase_blocks(shards: DataFrame, bits: list[np.ndarray], ranges: int) -> DataFrame:
    """(part, lang, width, phrases, n) of the phrases that have their bits, summed by task and packed by ranges of hashes.

    A phrase is in the sums of every task that meets it. Packed, that makes as many rows as there are tasks times ranges,
    and no phrase is a row of its own before its count is known.
    """
    shared = shards.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for lang, hashes, index in _indexes(batches):
            for width, phrase, size in _extended(lang, hashes, index, shared.value):
                if width < len(shared.value) + 2 and len(size):
                    sums.add(lang, phrase, size)
            if sums.rows > COMBINED_ROWS:
                sums.combine()
                if sums.rows > COMBINED_ROWS // 2:
                    yield from sums.blocks(ranges)
        sums.combine()
        yield from sums.blocks(ranges)

    return _over_shards(shards, run, "part bigint, lang string, width int, phrases binary, n binary")


def frequent_phrases(shards: DataFrame, bits: list[np.ndarray], least: int, ranges: int = RANGES) -> DataFrame:
    """(lang, g, a) of all phrases of at least `least` occurrences, summed range by range."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, limit = None, _Sums(), COMBINED_ROWS
        for batch in batches:
            for part, lang, width, phrases, n in zip(*(batch.column(c).to_pylist() for c in ("part", "lang", "width", "phrases", "n")), strict=True):
                if now != (part, lang, width):
                    yield from sums.taken(least)
                    now, limit = (part, lang, width), COMBINED_ROWS
                sums.add(lang, np.frombuffer(phrases, np.uint64).reshape(-1, width), np.frombuffer(n, np.int64))
                if sums.rows > limit:
                    sums.combine()
                    limit = max(COMBINED_ROWS, 2 * sums.rows)
        yield from sums.taken(least)

    blocks = phrase_blocks(shards, bits, ranges)
    return blocks.repartition("part").sortWithinPartitions("part", "lang", "width").mapInArrow(add, "lang string, g array<bigint>, a bigint")


def texts_of(shards: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, h, word) of the words (lang, h) and some others, from the shards that hold them."""
    shared = shards.sparkSession.sparkContext.broadcast(bitmap(word_keys(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data, texts in zip(*(batch.column(c).to_pylist() for c in ("lang", "hashes", "texts")), strict=True):
                h = np.frombuffer(data, np.uint64)
                at = np.flatnonzero(has_bit(shared.value, hash_of(lang, h)))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(h[at].view(np.int64)), pa.array([texts[i] for i in at], pa.string())], names=["lang", "h", "word"])

    return shards.select("lang", "hashes", "texts").mapInArrow(run, "lang string, h bigint, word string")


# --- phrases -------------------------------------------------------------------------------------------------

@contextmanager
def _single_rows(spark: SparkSession) -> Iterator[None]:
    """Shards are megabytes each: they travel to Python one by one."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, h, n; h null: all), phrases (lang, g, a) of at least `least` occurrences, and the shards."""
    spark = docs.sparkSession
    bounded_batches(spark)
    words = written(word_counts(docs).where((F.col("n") >= least) | F.col("h").isNull()), "words")
    frequent = bitmap(word_keys(words.where("h IS NOT NULL")))
    shards = written(build_shards(docs, frequent, longest, shard_words), "fm-shards")
    bits: list[np.ndarray] = []
    with _single_rows(spark):
        found = 0
        while len(bits) < longest - 1:
            keys = written(frequent_keys(shards, least, bits), "phrase-keys")
            more = keys.count()
            if not more:
                break
            found += more
            bits.append(bitmap(keys))
        phrases = written(frequent_phrases(shards, bits, least, max(RANGES, -(-found // COMBINED_ROWS))), "phrases")
    return words, phrases, shards


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, g, a, l, r, n, score): the lowest-scoring cut of every phrase that no frequent extension covers."""
    counts = written(phrases.select("lang", "g", F.col("a").alias("f")).unionByName(
        words.where("h IS NOT NULL").select("lang", F.array("h").alias("g"), F.col("n").alias("f"))), "counts")
    totals = words.where("h IS NULL").select("lang", "n")
    size = F.size("g")
    cuts = phrases.select("lang", "g", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "g", "a", "k", F.slice("g", F.lit(1), F.col("k")).alias("left"), F.slice("g", F.col("k") + 1, size).alias("right"))
    known = few_rows(counts, BROADCAST_ROWS)
    cuts = cuts.join(known.select("lang", F.col("g").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        known.select("lang", F.col("g").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(few_rows(totals, BROADCAST_ROWS), "lang")
    wide = "cast({} as decimal(19,0))"
    score = F.expr(f"({SCALE} * {wide.format('a')} * {wide.format('n')}) div ({wide.format('l')} * {wide.format('r')})")
    best = cuts.withColumn("score", score).groupBy("lang", "g").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"), F.min("a").alias("a"), F.min("n").alias("n"))
    inside = phrases.where(size > 2).select("lang", F.col("a").alias("covered"), F.explode(F.array(F.slice("g", F.lit(1), size - 1), F.slice("g", F.lit(2), size - 1))).alias("g"))
    inside = inside.groupBy("lang", "g").agg(F.max("covered").alias("covered"))
    best = best.join(inside, ["lang", "g"], "left").where(F.col("covered").isNull() | (F.col("covered") < F.col("a")))
    return best.select("lang", "g", "a", "c.l", "c.r", "n", "c.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language."""
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    words, phrases, shards = phrase_counts(docs, least, longest, shard_words)
    first = written(scored(words, phrases).withColumn("_at", F.expr("rank() OVER (PARTITION BY lang ORDER BY score DESC, a DESC)")).where(F.col("_at") <= top).withColumn(
        "_id", F.monotonically_increasing_id()), "first-phrases")
    used = first.select("_id", "lang", F.posexplode("g").alias("i", "h"))
    needed = used.select("lang", "h").distinct()
    with _single_rows(docs.sparkSession):
        texts = written(texts_of(shards, needed), "texts")
    named = texts.join(few_rows(needed, BROADCAST_ROWS), ["lang", "h"]).groupBy("lang", "h").agg(F.min("word").alias("word"), F.max("word").alias("last"))
    named = written(named.select("lang", "h", F.when(F.col("word") == F.col("last"), F.col("word")).otherwise(F.raise_error(F.lit("two words of one hash"))).alias("word")), "words-named")
    phrase = used.join(named, ["lang", "h"]).groupBy("_id").agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"])).alias("phrase"))
    ranked = first.join(phrase, "_id").withColumn("rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
