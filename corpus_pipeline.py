"""A corpus pipeline of five stages; each takes the documents that the stage before kept.

A stage is called with the session, the documents and the folder of the other tables. It keeps the columns of
`documents` and drops rows; the last one gives each document's tokens as digests, with doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, ngram_join, quality_classifier, quality_rules
from tidemark.llm.common import written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on these documents, keeps."""
    return quality_classifier.clean(docs)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fences of their language and source."""
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the decoded text."""
    return bpe.round_trip(docs.select("doc_id", "text")).drop("text")


STAGES = [
    ("quality classifier", classify),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", tokens),
]

#: Trained and hashed stages have no SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
