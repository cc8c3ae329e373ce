"""Line dedup against levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A run holds the 128-bit keys of lines that no earlier
batch had, each with its largest document and its number of documents; it is a table bucketed and sorted by key. A new
batch is merge-joined with the runs: what none of them has (the anti part) becomes its own run, what one of them has
only adds to a count. Two runs of a level are merged into one of the next level before a further batch comes, so a
batch meets at most log2(batches) runs. Runs never share a key, so whatever batch has a key first names the document
that keeps its lines. All of this is joins of equally bucketed tables: after one shuffle of keys, nothing moves again.

A line's key is the line without white space at its ends, with A-Z in lower case. Keys of at least `least_chars` code
points in at least `least_docs` documents lose their lines but in the largest document id that holds them.

Nulls and repeats: a null or empty text is one empty line. Every row counts as a document, whether or not its id or
text is repeated. A null id is smaller than all others; rows of the largest id all keep their lines.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, few_rows, slices, work_folder, written

#: White space that is stripped at the ends of a line.
SPACE = b" \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS, BATCHES = 20, 3, 4
#: Keys in a bucket of a run, on average; keys of lines to drop that are broadcast at most (40 bytes each).
BUCKET_KEYS, BROADCAST_KEYS = 2_000_000, 500_000
_NO_ID = -(1 << 63)


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """Hash of a line's key, or None if the key is too short."""
    line = line.strip(SPACE)
    if len(line) < least_chars:
        return None
    if len(line) < 4 * least_chars and not line.isascii() and sum(1 for b in line if b & 0xC0 != 0x80) < least_chars:
        return None
    return xxhash.xxh3_128_digest(line.lower())


def line_pairs(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, key) of the distinct keys of each row of `docs` (doc, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc").to_pylist()
            for first, texts in slices(batch.column("text")):
                doc, key = [], []
                for i, text in enumerate(texts, first):
                    own = {k for line in text.split(b"\n") if (k := line_key(line, least_chars)) is not None}
                    doc += [ids[i]] * len(own)
                    key += own
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(key, pa.binary())], names=["doc", "key"])

    return docs.mapInArrow(run, "doc bigint, key binary")


class LineRuns:
    """The runs, by level, and the counts that later batches added to their keys."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.levels: list[list[DataFrame]] = []
        self.again: list[DataFrame] = []
        self._tables: list[str] = []

    def bucketed(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """`df` as a table in the shared folder, bucketed and sorted by key, in folders by the column `by`."""
        name = f"tidemark_lines_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("path", work_folder(self.spark, "lines")).bucketBy(self.buckets, "key").sortBy("key")
        (writer.partitionBy(by) if by else writer).saveAsTable(name)
        self._tables.append(name)
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _compact(self) -> None:
        """Merge levels of two runs, from below."""
        for i in range(len(self.levels)):
            if len(self.levels[i]) == 2:
                a, b = self.levels[i]
                # No key is in both, so the full outer merge join is a merge of two sorted runs.
                merged = a.join(b.withColumnsRenamed({"docs": "_docs", "last": "_last"}).hint("merge"), "key", "full_outer").select(
                    "key", F.coalesce("docs", "_docs").alias("docs"), F.coalesce("last", "_last").alias("last"))
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self.bucketed(merged))
                self.levels[i] = []

    def add(self, batch: DataFrame) -> None:
        """Merge a batch (key, docs, last) of distinct keys with the runs; what is new becomes a run."""
        self._compact()
        known = []
        for i, run in enumerate(self.runs()):
            batch = batch.join(run.select("key", F.lit(True).alias(f"_in_{i}")).hint("merge"), "key", "left")
            known.append(F.col(f"_in_{i}"))
        seen = F.coalesce(*known, F.lit(False)) if known else F.lit(False)
        split = self.bucketed(batch.select("key", "docs", "last", seen.alias("seen")), "seen")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(split.where("NOT seen").select("key", "docs", "last"))
        if known:
            self.again.append(split.where("seen").select("key", "docs"))

    def frequent(self, least_docs: int) -> DataFrame:
        """(key, last) of the keys in at least `least_docs` documents."""
        more = None
        if self.again:
            more = reduce(DataFrame.unionByName, self.again).groupBy("key").agg(F.sum("docs").alias("more"))
        parts = []
        for run in self.runs():
            if more is not None:
                run = run.join(more, "key", "left").withColumn("docs", F.col("docs") + F.coalesce("more", F.lit(0)))
            parts.append(run.where(F.col("docs") >= least_docs).select("key", "last"))
        return reduce(DataFrame.unionByName, parts)

    def forget(self) -> None:
        """Take the runs out of the session's catalog; their files stay in the shared folder."""
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables = []


def frequent_lines(pairs: DataFrame, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """(key, last) of the keys that at least `least_docs` rows hold, by runs over `batches` ranges of ids."""
    spark = pairs.sparkSession
    total, borders = pairs.agg(F.count("*"), F.percentile_approx("doc", [i / batches for i in range(1, batches)] or [0.5], 1000)).first()
    borders = sorted(set(borders or []))[:batches - 1]
    runs = LineRuns(spark, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_KEYS)))
    later = reduce(lambda n, border: n + (F.col("doc") < border).cast("int"), borders, F.lit(0))
    # Combined in the tasks that read, so that a line of all documents is one row of each.
    keys = pairs.groupBy("key", later.alias("batch")).agg(F.count("*").alias("docs"), F.max("doc").alias("last"))
    keys = runs.bucketed(keys.repartition(runs.buckets, "key"), "batch")
    for i in range(len(borders) + 1):
        runs.add(keys.where(F.col("batch") == i).select("key", "docs", "last"))
    found = written(runs.frequent(least_docs), "frequent-lines")
    runs.forget()
    return found


def _without(text: bytes, gone: set[bytes], least_chars: int) -> tuple[int, int, bytes]:
    lines = text.split(b"\n")
    kept = [line for line in lines if line_key(line, least_chars) not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def without_lines(text: Column, gone: Column, least_chars: int = LEAST_CHARS) -> Column:
    """struct(n_lines, n_dropped, kept) of a text and the keys of the lines it loses (null: none)."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in batches:
            keys, out = keys.to_pylist(), []
            for first, part in slices(texts):
                for i, t in enumerate(part, first):
                    out.append(_without(t, set(keys[i]), least_chars) if keys[i] else (t.count(b"\n") + 1, 0, t))
            n, dropped, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["n_lines", "n_dropped", "kept"])

    return F.arrow_udf(run, "struct<n_lines:bigint,n_dropped:bigint,kept:string>")(text, gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row: lines before, lines dropped, and what stays."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.col(text_col).alias("text"))
    pairs = written(line_pairs(docs.select("doc", "text"), least_chars), "line-keys")
    found = frequent_lines(pairs, least_docs, batches)
    drops = written(pairs.join(few_rows(found, BROADCAST_KEYS), "key").where("doc < last").groupBy("doc").agg(F.collect_set("key").alias("gone")), "line-drops")
    # A text moves only if the documents that lose lines are too many to send to all tasks.
    few = drops.agg(F.count("*"), F.sum(F.size("gone"))).first()
    marked = docs.join(F.broadcast(drops) if few[0] + (few[1] or 0) <= BROADCAST_KEYS else drops, "doc", "left")
    return marked.select("doc_id", without_lines(F.col("text"), F.col("gone"), least_chars).alias("r")).select(
        "doc_id", "r.n_lines", "r.n_dropped", F.col("r.kept").alias("text"))
