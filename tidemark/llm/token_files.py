"""Token ids in seekable zstandard files: one frame per document, a trailing seek table, a checksum per frame.

A file holds documents in ascending id order. Each document's ids (little-endian unsigned 32-bit integers, with an end
id) are an independent zstandard frame. After them come a skippable frame with the documents' ids and the seek table
of the public seekable format: compressed size, size and low 32 bits of the XXH64 of every frame. A reader takes the
table from the end of the file, and fetches and decompresses just the frames it needs.

Writing: documents are encoded and compressed where they are read (frames go to the shared folder once), and the much
smaller frames are dealt out by ranges of ids, sorted, and appended to one file per range, which appears when it is
complete. The manifest has one row per file.

A text without ids (null, empty) is a frame with the end id alone. A null document id sorts first. Rows with one id
are neighbours, in the order of their bytes. Texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import VOCABULARY, Chunks, as_bytes
from tidemark.llm.common import bounded_batches, slices, work_folder, written
from tidemark.llm.storage import open_ranges, whole_file

#: Fixed values of the public seekable format, and the skippable frame that holds the document ids.
SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
#: The letter that stands for a space in tokens of a byte-level model (fixed value), how many distinct chunks are one text
#: for the library, and how much text shares its chunks.
SPACE, JOINED_CHUNKS, TOGETHER_BYTES = "\u0120", 1000, 1 << 23
END_ID, LEVEL, FILE_BYTES, READ_DOCS = 0, 3, 128 << 20, 5_000
NULL_ID = -(1 << 63)


class Encoder:
    """The tokenizers library over whole texts. Where nothing but a byte-level split comes before its model, the library splits
    and encodes each distinct space-led chunk of a run of texts once; ids of pieces and of chunks encoded alone are kept."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        split = model.get("pre_tokenizer") or {}
        self._special = [t["content"] for t in model["added_tokens"]]
        self._by_pieces = (model["normalizer"] is None and model["post_processor"] is None and split.get("type") == "ByteLevel"
                           and split.get("use_regex", True) and not split.get("add_prefix_space"))
        self._library.no_truncation()
        self._library.no_padding()
        tokenize = self._library.model.tokenize
        names = self._library.get_vocab(with_added_tokens=True)
        self._leads = np.zeros(max(names.values()) + 1, bool)
        self._leads[[i for name, i in names.items() if name.startswith(SPACE)]] = True
        if self._by_pieces:
            split = self._library.pre_tokenizer.pre_tokenize_str  # pieces in the letters of the model
            self._chunks = Chunks(lambda chunk: [piece for piece, _ in split(chunk)], lambda piece: [t.id for t in tokenize(piece)])

    def whole(self, text: str) -> bytes:
        """By the library's own call alone."""
        return as_bytes(self._library.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if not self._by_pieces or any(t in text for t in self._special):
            return self.whole(text)
        return self._chunks.encode(text)

    def _together(self, chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(places, ids as bytes) of most of some distinct chunks. The library encodes many of them as one text; a chunk
        begins where an id's token begins with the letter of the space, which stands nowhere else in it."""
        if any(" " in t for t in self._special):
            return np.zeros(0, np.int64), pa.array([], pa.large_binary())
        # White space at a chunk's end could grow together with that of its neighbour; such chunks are encoded alone.
        bare = pc.and_(pc.equal(pc.utf8_trim_whitespace(chunks), chunks), pc.invert(pc.match_substring_regex(chunks, "^[\x1c-\x1f]|[\x1c-\x1f]$")))
        place = np.flatnonzero(pc.and_(bare, pc.not_equal(chunks, "")).to_numpy(zero_copy_only=False))
        if not len(place):
            return place, pa.array([], pa.large_binary())
        at = np.append(np.arange(0, len(place), JOINED_CHUNKS), len(place))
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), chunks.take(pa.array(place))), pa.scalar(" ", pa.large_string()))
        found, sizes, ids = np.ones(len(place), bool), [], []
        for first, last, coded in zip(at[:-1], at[1:], self._library.encode_batch_fast([" " + t for t in texts.to_pylist()], add_special_tokens=False), strict=True):
            run = np.array(coded.ids, "<u4")
            starts = np.flatnonzero(self._leads[run])
            if len(starts) == last - first:
                sizes.append(np.diff(starts, append=len(run)))
                ids.append(run)
            else:
                found[first:last] = False
        ends = 4 * np.concatenate([np.zeros(1, np.int64), *sizes]).cumsum()
        data = pa.py_buffer(np.concatenate([np.zeros(0, "<u4"), *ids]).tobytes())
        return place[found], pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), data])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As `encode`, for texts at once: their distinct chunks are encoded together and put together again by column."""
        out: list[bytes | None] = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if self._by_pieces and text and not any(t in text for t in self._special) and self._chunks.splits(text):
                plain.append(i)
            else:
                out[i] = self.encode(text) if text else b""
        if not plain:
            return out
        lists = pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        offsets, coded = lists.offsets, lists.values.dictionary_encode()
        place, ids = self._together(coded.dictionary)
        alone = np.ones(len(coded.dictionary), bool)
        alone[place] = False
        alone = np.flatnonzero(alone)
        ids = pa.concat_arrays([ids, pa.array([*(self._chunks[c] for c in coded.dictionary.take(pa.array(alone)).to_pylist()), b""], pa.large_binary())])
        row = np.empty(len(coded.dictionary), np.int64)
        row[place], row[alone] = np.arange(len(place)), np.arange(len(place), len(row))
        # A text's first chunk has no space before it.
        first = offsets.to_numpy()[:-1]
        at = row[coded.indices.to_numpy()]
        at[first] = len(row)
        rest = pc.binary_join(pa.LargeListArray.from_arrays(offsets.cast(pa.int64()), ids.take(pa.array(at))), pa.scalar(b"", pa.large_binary()))
        for i, head, tail in zip(plain, lists.values.take(pa.array(first)).to_pylist(), rest.to_pylist(), strict=True):
            out[i] = self._chunks.by_pieces(head) + tail
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_frames(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, level: int = LEVEL) -> DataFrame:
    """(doc_id, n_tokens, checksum, frame) of every document."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def gathered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Batches put together to about TOGETHER_BYTES; a larger one stays as it is."""
        held, size = [], 0
        for texts in batches:
            if held and size + texts.nbytes > TOGETHER_BYTES:
                yield pa.concat_arrays(held)
                held, size = [], 0
            held.append(texts)
            size += texts.nbytes
        if held:
            yield pa.concat_arrays(held)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, compress = encoder(path).encode_all, zstandard.ZstdCompressor(level=level).compress
        for texts in gathered(batches):
            counts, sums, frames = [], [], []
            for _, part in slices(texts, TOGETHER_BYTES):
                for ids in encode([t.decode() for t in part]):
                    ids += end
                    counts.append(len(ids) // 4)
                    sums.append(xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
                    frames.append(compress(ids))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(frames, pa.binary())],
                                             names=["n_tokens", "checksum", "frame"])

    made = F.arrow_udf(run, "struct<n_tokens:bigint,checksum:bigint,frame:binary>")(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), made.alias("t")).select("doc_id", "t.*")


def write_token_files(docs: DataFrame, folder: str | None = None, path: str | None = None, file_bytes: int = FILE_BYTES, **options) -> DataFrame:
    """Write the files below `folder` (a URI) and return the manifest: file, part, docs, tokens."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "tokens")
    frames = written(token_frames(docs, path or public_tokenizers.path(VOCABULARY), **options), "frames")
    size = frames.agg(F.sum(F.octet_length("frame") + 20)).first()[0] or 0
    parts = max(-(-size // file_bytes), spark.sparkContext.defaultParallelism if size > (1 << 20) else 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table, ids, tokens = TaskContext.get().partitionId(), [], [], 0
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        uri = f"{folder}/part-{part:06d}.zst"
        with whole_file(uri) as out:
            while first is not None:
                for doc, n, checksum, frame in zip(*(first.column(c).to_pylist() for c in ("doc_id", "n_tokens", "checksum", "frame")), strict=True):
                    out.write(frame)
                    table.append(struct.pack("<III", len(frame), 4 * n, checksum))
                    ids.append(NULL_ID if doc is None else doc)
                    tokens += n
                first = next(batches, None)
            index = zstandard.ZstdCompressor().compress(np.array(ids, "<i8").tobytes())
            out.write(struct.pack("<II", SKIPPABLE_IDS, len(index)) + index)
            table.append(struct.pack("<III", len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
            body = b"".join(table) + struct.pack("<IBI", len(table), CHECKSUMS, SEEKABLE)
            out.write(struct.pack("<II", SKIPPABLE_TABLE, len(body)) + body)
        yield pa.RecordBatch.from_pydict({"file": [uri], "part": [part], "docs": [len(ids)], "tokens": [tokens]},
                                         schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    ordered = frames.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "frame")
    return written(ordered.mapInArrow(write, "file string, part int, docs bigint, tokens bigint"), "manifest")


class TokenFile:
    """One file opened for reading by place."""

    def __init__(self, uri: str):
        self._file = open_ranges(uri)
        end = self._file.size()
        frames, flags, magic = struct.unpack("<IBI", self._file.read_at(9, end - 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError(f"{uri} has no seek table with checksums")
        rows = np.frombuffer(self._file.read_at(12 * frames, end - 9 - 12 * frames), "<u4").reshape(-1, 3)
        self.start = np.concatenate([[0], np.cumsum(rows[:, 0], dtype=np.int64)])
        self.size, self.checksum = rows[:, 1].astype(np.int64), rows[:, 2]
        index = self._file.read_at(int(rows[-1, 0]) - 8, int(self.start[-2]) + 8)
        self.doc_ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(index), "<i8")
        self.n_tokens = self.size[:-1] // 4
        self._decompress = zstandard.ZstdDecompressor().decompress

    def ids(self, first: int, last: int) -> Iterator[bytes]:
        """The ids of documents first to last - 1, from one range read; each frame is checked."""
        begin = int(self.start[first])
        block = self._file.read_at(int(self.start[last]) - begin, begin)
        for k in range(first, last):
            ids = self._decompress(block[self.start[k] - begin:self.start[k + 1] - begin], max_output_size=int(self.size[k]))
            if xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.checksum[k]:
                raise ValueError(f"frame {k} is damaged")
            yield ids

    def close(self) -> None:
        self._file.close()


def _starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the ids in all files before; one row per file passes through one task."""
    return manifest.selectExpr("*", "coalesce(sum(tokens) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start")


def _read(manifest: DataFrame, schema: str, row, read_docs: int) -> DataFrame:
    """`row(doc_id, start, ids)` for all documents, in parallel over ranges of frames."""
    ranges = _starts(manifest).select("file", "start", "docs", F.explode(F.expr(f"sequence(0L, docs - 1, {read_docs}L)")).alias("first"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, start, docs, first in batch.itertuples(index=False):
                opened, last = TokenFile(file), min(first + read_docs, docs)
                starts = start + np.concatenate([[0], np.cumsum(opened.n_tokens)])
                for at in range(first, last, 500):
                    to = min(at + 500, last)
                    yield pd.DataFrame([row(None if opened.doc_ids[k] == NULL_ID else int(opened.doc_ids[k]), int(starts[k]), ids)
                                        for k, ids in zip(range(at, to), opened.ids(at, to), strict=True)], columns=[c.split()[0] for c in schema.split(", ")]).astype({"doc_id": "Int64"})
                opened.close()

    return ranges.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4).mapInPandas(run, schema)


def read_token_files(manifest: DataFrame, read_docs: int = READ_DOCS) -> DataFrame:
    """(doc_id, start, ids) of all documents."""
    return _read(manifest, "doc_id bigint, start bigint, ids array<bigint>", lambda doc, start, ids: (doc, start, np.frombuffer(ids, "<u4").astype(np.int64)), read_docs)


def read_digests(manifest: DataFrame, read_docs: int = READ_DOCS) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the files."""
    return _read(manifest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
                 lambda doc, start, ids: (doc, start, len(ids) // 4, zlib.crc32(ids)), read_docs)


def read_documents(uri: str, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file; no other frame is fetched."""
    opened, found = TokenFile(uri), {}
    for doc in doc_ids:
        for k in range(*np.searchsorted(opened.doc_ids, [doc, doc + 1])):
            found[doc] = np.frombuffer(next(opened.ids(k, k + 1)), "<u4")
    opened.close()
    return found
