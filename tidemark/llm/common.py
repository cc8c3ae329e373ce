"""Helpers the operators share: work folders, bounded batches, byte-level word tables and components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: Text that a Python task handles at once. A longer document makes a larger slice of its own.
SLICE_BYTES = 1 << 19

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Odd, so that it has an inverse modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_KEYS = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, as a URI. Its user removes nothing: it lives as long as the checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


#: Spark's setting (since 4.1) that deletes a query's shuffle files when it ends, not when the driver collects its garbage.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends there, and lost executors lose nothing.

    The write's shuffle files go with it, so that a job of many steps needs the disk of its largest one.
    """
    spark, path = df.sparkSession, work_folder(df.sparkSession, name)
    was = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if was is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most `rows` rows, so that some hundred long texts don't meet in one message."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Hand memory that is free again back to the system, so that a worker that is used again starts small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 of the texts) for runs of rows of about `limit` bytes; a null is an empty text.

    Free memory is given back after the last run.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    start, size, run = 0, 0, []
    for i, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        text = text or b""
        if run and size + len(text) > limit:
            yield start, run
            start, size, run = i, 0, []
        run.append(text)
        size += len(text)
    if run:
        yield start, run
    del run
    give_back()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            full = np.full(1 << int(n - 1).bit_length(), base, np.uint64)
            full[0] = 1
            _powers[key] = np.cumprod(full, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Spans:
    """64-bit hashes of any spans of a byte buffer, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, buffer: np.ndarray):
        up, self._down = _power_table(len(buffer) + 1)
        self._sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_BYTE_KEYS[buffer] * up[:-1], dtype=np.uint64, out=self._sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(h + (end - start).astype(np.uint64))


class Words:
    """Words (runs of bytes outside `breaks`) of a run of texts: buffer, document borders, word borders, word document."""

    def __init__(self, texts: list[bytes], breaks: np.ndarray = WHITE):
        self.buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_end = np.cumsum(lengths + 1) - 1
        self.doc_start = self.doc_end - lengths
        inside = ~breaks[self.buffer]
        inside[self.doc_end] = False
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edges[0::2], edges[1::2]
        self.count = np.searchsorted(self.start, self.doc_end) - np.searchsorted(self.start, self.doc_start)
        self.first = np.cumsum(self.count) - self.count
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self) -> np.ndarray:
        return Spans(self.buffer).hashes(self.start, self.end)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each document; the separator after it must not be flagged."""
        return np.add.reduceat(flags, self.doc_start, dtype=np.int64)


def runs_of(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of `width` words inside one document."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(doc[:n] == doc[width - 1:])
    h = np.zeros(len(first), np.uint64)
    for k in range(width):
        h = h * _BASE + hashes[first + k]
    return first, mix(h)


def few_rows(df: DataFrame, limit: int) -> DataFrame:
    """`df` with a broadcast hint if it has at most `limit` rows (counted); otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: Rows of two longs that a task of `components` works on at once.
EDGE_ROWS = 100_000


def tied(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that the edges lead to) of the nodes of some edges that are not the smallest themselves."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(label, high[apart], low[apart])
        while not np.array_equal(label, label[label]):
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node that links lead to.

    Rounds of large-star and small-star: every node hands its smallest neighbour on to the others. A round is two
    aggregates by node, each joined back by a shuffle; its result is written to the shared folder in as many files as its
    number of rows asks for. What fits a single task (EDGE_ROWS edges) is finished by it without rounds: the driver's
    memory goes into the plans and broadcasts of rounds. Nothing is collected but a count and a sum.
    """
    def both(e):
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def star(pairs):
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least.hint("merge"), "u")

    def state(e):
        rows, total = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return int(rows), total

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
        if parts:
            node, least = tied(np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], names=["a", "b"])

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), name)
    seen = state(now)
    while seen[0] > EDGE_ROWS:
        # Every edge becomes one edge, so there are never more of them.
        large = star(both(now)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = star(large)
        small = small.where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a > b").distinct()
        now = written(small.coalesce(-(-seen[0] // EDGE_ROWS)), name)
        was, seen = seen, state(now)
        if was == seen:
            break
    else:
        if seen[0]:
            now = written(now.coalesce(1).mapInArrow(finish, "a bigint, b bigint"), name)
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.unionByName(labels.select(F.col("component").alias("node"), "component").distinct())
