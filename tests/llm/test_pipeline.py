"""The pipeline against its stages done plainly, and its stages' contract."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tests.llm.test_operators import plain_counts, plain_decontaminate, plain_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
    return kept


def test_columns_stay_and_rows_only_go(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {tuple(r) for r in docs.collect()}
    for stage in stages[:-1]:
        assert stage.columns == docs.columns
        now = {tuple(r) for r in stage.collect()}
        assert now <= before and len(now) > len(before) / 2
        before = now


def test_each_stage_does_its_part(stages):
    classified, ruled, single, clean, tokens = ([r for r in s.collect()] for s in stages)
    assert all(c["n_words"] >= 50 and 100 * c["n_repeat_words"] <= 50 * c["n_words"] for c in (plain_counts(r.text) for r in ruled))
    groups = {doc: component for doc, _, component in plain_groups([(r.doc_id, r.text) for r in ruled])}
    assert sorted(r.doc_id for r in single) == sorted(d for d, c in groups.items() if d == c)
    items = [(r.item_id, r.text) for r in stages[0].sparkSession.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = {r[0]: r[5] for r in plain_decontaminate([(r.doc_id, r.text) for r in single], items)}
    assert sorted(r.doc_id for r in clean) == sorted(d for d, hit in found.items() if not hit) and any(found.values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = {r.doc_id: (len(library.encode(r.text, add_special_tokens=False).ids), hashlib.sha256(r.text.encode()).hexdigest()) for r in clean}
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in tokens} == counts


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_stages_take_odd_documents(spark):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (2, "", "en", "s", 0, 2), (None, "a b", "en", None, 3, 3), (3, "word " * 5000, "de", "s", 25_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() <= len(rows)
