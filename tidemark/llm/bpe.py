"""Byte-level BPE: exact merges by a backtracking encoder, and decoding by an offset table.

A vocabulary's tokens (byte strings, ids in merge order) go into an Aho-Corasick automaton. For a piece of text it
gives the longest token that starts at every byte. The encoder takes the longest match at each place, provided that
the pair with the token before is compatible: encoding the two tokens' joint bytes must give just these two, which is
checked by taking both apart along the merges, and remembered in a pair table. If no match is compatible it goes back
one token and takes that token's longest proper prefix token. A bitmap of dead ends keeps a place from being tried
twice, so the time is linear in the piece, and the result equals merging by rank.

Pieces come from the vocabulary's published split pattern; special tokens in a text stand for their ids. The pattern is
about classes of characters, and tables of those differ between versions of Unicode: a text with a character that the
`regex` module classes otherwise than the tokenizers library is split by the library. As words
repeat, a worker keeps the ids of up to CACHED_PIECES pieces and as many space-led chunks: a piece never crosses a space that follows a
visible character, so a text without other white space before a space is the sum of such chunks.

Nulls and empty texts have no ids. Texts are encoded whole.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tidemark.llm.common import bounded_batches, give_back

CACHED_PIECES = 500_000
VOCABULARY = "byte_bpe_50k.json"
#: A space after white space: there the pieces of a text are not those of its chunks.
_BROKEN_SPACE = re.compile(r"\s ")


def byte_letters() -> dict[str, int]:
    """The published rule that gives every byte a printable letter: printable Latin-1 bytes are themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Chunks(dict):
    """Space-led chunk (without the space) -> ids as bytes, from the ids of its pieces. Either table is emptied when it is full."""

    def __init__(self, split, encode_piece):
        super().__init__()
        self._split, self._encode_piece, self._pieces = split, encode_piece, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.clear()
        ids = self[chunk] = self.by_pieces(" " + chunk)
        return ids

    def by_pieces(self, text: str) -> bytes:
        known, out = self._pieces, []
        for piece in self._split(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= CACHED_PIECES:
                    known.clear()
                ids = known[piece] = as_bytes(self._encode_piece(piece))
            out.append(ids)
        return b"".join(out)

    def splits(self, text: str) -> bool:
        """Whether no piece of a text crosses one of its spaces."""
        return bool(text) and text[0] != " " and text[-1] != " " and not _BROKEN_SPACE.search(text)

    def encode(self, text: str) -> bytes:
        if not self.splits(text):
            return self.by_pieces(text)
        first, *rest = text.split(" ")
        return self.by_pieces(first) + b"".join([self[chunk] for chunk in rest])


def _kind(split, c: str) -> tuple[int, ...]:
    """Tells letters, digits, white space and other characters apart, by what a character makes one piece with."""
    return tuple(len(split(before + c)) for before in "a1!")


class Split:
    """Pieces of a text by the pattern, or by the library where their tables class a character differently."""

    def __init__(self):
        self._by_pattern, self._library = regex.compile(public_tokenizers.PATTERN).findall, pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self._alike: set[str] = set()
        self._other: set[str] = set()

    def __call__(self, text: str) -> list[str]:
        if not self._alike.issuperset(text):
            for c in set(text) - self._alike - self._other:
                (self._alike if _kind(self._by_pattern, c) == _kind(self._library, c) else self._other).add(c)
            if not self._other.isdisjoint(text):
                return [text[a:b] for _, (a, b) in self._library(text)]
        return self._by_pattern(text)


class Vocabulary:
    """Tokens, merges, special tokens and the tables made of them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ids = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        self.size = 1 + max([*ids.values(), *special.values()])
        self.bytes_of = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = token
        self.special = special
        #: (left, right) -> (rank, id) of a merge; id -> the pair it is merged from, and that merge's rank.
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = (bytes(letters[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            if (ids[a], ids[b]) not in self.merges and a + b in ids:
                self.merges[ids[a], ids[b]] = (rank, ids[a + b])
                self.parts.setdefault(ids[a + b], (ids[a], ids[b]))
        self.rank_of = {i: self.merges[p][0] for i, p in self.parts.items()}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in ids.items():
            if len(token) == 1 or i in self.parts:  # others are never the result of a merge
                self._automaton.add_word(token.decode("latin-1"), i)
        self._automaton.make_automaton()
        self._prefix: dict[int, int] = {}
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._chunks = Chunks(Split(), lambda piece: self.encode_piece(piece.encode()))

        whole = [*self.bytes_of]
        for text, i in special.items():
            whole[i] = text.encode()
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in whole])]).astype(np.int64)
        self.table = np.frombuffer(b"".join(whole), np.uint8)

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of a token, or -1."""
        found = self._prefix.get(token)
        if found is None:
            text = self.bytes_of[token].decode("latin-1")
            found = next((i for n in range(len(text) - 1, 0, -1) if (i := self._automaton.get(text[:n], -1)) >= 0), -1)
            self._prefix[token] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side survive merging: no merge across their border comes before theirs."""
        known = self._pairs.get((left, right))
        if known is None:
            known = self._pairs[left, right] = self._survives(left, right)
        return known

    def _survives(self, left: int, right: int) -> bool:
        limit = 1 << 60
        while True:
            merged = self.merges.get((left, right))
            if merged is not None and merged[0] < limit:
                return False
            rank_l, rank_r = self.rank_of.get(left, -1), self.rank_of.get(right, -1)
            if rank_l < 0 and rank_r < 0:
                return True
            # Take apart the token that was merged last. A merge across the border stands to the left of the right
            # token, so of equal ranks it would come first.
            if rank_l > rank_r:
                limit, left = rank_l, self.parts[left][1]
            else:
                limit, right = rank_r + 1, self.parts[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        text, n = piece.decode("latin-1"), len(piece)
        longest = [-1] * n
        for end, token in self._automaton.iter(text):  # at each end the longest match comes first, so the last one for a start is the longest
            longest[end - len(self.bytes_of[token]) + 1] = token
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            before = out[-1] if out else -1
            while True:
                end = at + len(self.bytes_of[token])
                if not dead[end] and (before < 0 or self.compatible(before, token)):
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                shorter = self.shorter(token)
                if shorter >= 0:
                    token = shorter
                    continue
                # Nothing fits here: mark the place, and try a shorter token before it.
                dead[at] = 1
                token = out.pop()
                at -= len(self.bytes_of[token])
                before = out[-1] if out else -1
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(name in text for name in self.special):
            return self._chunks.encode(text)
        return b"".join(self.special[part].to_bytes(4, "little") if part in self.special else self._chunks.encode(part)
                        for part in self._special.split(text))

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes one after another, gathered from the table by their offsets."""
        start, length = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        before = np.cumsum(length) - length
        return self.table[np.repeat(start - before, length) + np.arange(length.sum())].tobytes()

    def decode_text(self, ids: np.ndarray) -> str:
        """As text; bytes that are not UTF-8 become the replacement character."""
        return self.decode(ids).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker; the file is part of the Python environment of every executor."""
    return Vocabulary(path)


def _drop_tables() -> None:
    """Workers are used again by other stages, which need the memory of the tables and of the pieces kept in them."""
    vocabulary.cache_clear()
    gc.collect()
    give_back()


def _encoded(path: str):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(path)
        for texts in batches:
            yield pa.array([np.frombuffer(vocab.encode(t or ""), "<u4").astype(np.int32) for t in texts.to_pylist()], pa.list_(pa.int32()))
        del vocab
        _drop_tables()
    return run


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """`docs` with the ids of its texts as an array column."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out_col, F.arrow_udf(_encoded(path or public_tokenizers.path(VOCABULARY)), "array<int>")(F.col(text_col)))


def decode(docs: DataFrame, path: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`docs` with the text of an id array column; null ids give an empty text."""
    where = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(where)
        for ids in batches:
            yield pa.array([vocab.decode_text(np.array(x or [], np.int64)) for x in ids.to_pylist()], pa.string())
        del vocab
        _drop_tables()

    return docs.withColumn(out_col, F.arrow_udf(run, "string")(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256: encoded and decoded in one pass, ids leave the task only as digests."""
    bounded_batches(docs.sparkSession)
    where = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(where)
        for texts in batches:
            counts, of_ids, of_text = [], [], []
            for text in texts.to_pylist():
                ids = vocab.encode(text or "")
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(vocab.decode_text(np.frombuffer(ids, "<u4").astype(np.int64)).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                                             names=["n_tokens", "ids_sha256", "decoded_sha256"])
        del vocab
        _drop_tables()

    marked = docs.withColumn("__b", F.arrow_udf(run, "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")(F.col(text_col)))
    return marked.select(*[marked[c] for c in docs.columns], "__b.*")
