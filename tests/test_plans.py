"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from tests.test_merge import SCHEMA
from tidemark.operators import merge, progress, reconcile, unkeyed
from tidemark.plans.replicate import stage_events
from tidemark.sources.changelog import parse_changes, parse_events
from tests.replay import envelope


def executed(df):
    """The final adaptive plan after a run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def typed(spark, tmp_path):
    """A log on disk, so that scans can be counted."""
    raw = spark.createDataFrame([(i, envelope("cud"[i % 3], "t", {"k": i % 50, "a": "x", "b": 1}, {"k": i % 50, "a": "x", "b": 1}))
                                 for i in range(600)], "seq bigint, value string")
    raw.write.parquet(str(tmp_path / "log"))
    from tidemark.sources.changelog import decode_images
    return decode_images(parse_changes(spark.read.parquet(str(tmp_path / "log")))[0], SCHEMA, keys=["k"])


def test_keyed_replay_combines_before_the_shuffle(typed):
    plan = executed(merge.apply_changes(None, typed, ["k"], partial=False))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan
    assert plan.count("from_json") == 1 and "Window" not in plan


@pytest.mark.parametrize("partial", [False, True])
def test_log_is_parsed_once_even_with_a_base(spark, typed, partial):
    base = spark.range(200).selectExpr("id AS k", "'x' AS a", "1.0D AS b")
    plan = executed(merge.apply_changes(base, typed, ["k"], partial=partial))
    assert plan.count("from_json") == 1


def test_small_batches_are_broadcast_against_the_base(spark, typed, tmp_path):
    spark.range(200).selectExpr("id AS k", "'x' AS a", "1.0D AS b").write.parquet(str(tmp_path / "base"))
    plan = executed(merge.apply_changes(spark.read.parquet(str(tmp_path / "base")), typed, ["k"], partial=False))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("apply", [merge.apply_partial, merge.apply_key_only])
def test_partial_changes_move_none_of_the_base(spark, typed, tmp_path, apply):
    spark.range(200).selectExpr("id AS k", "'x' AS a", "1.0D AS b").write.parquet(str(tmp_path / "base"))
    plan = executed(apply(spark.read.parquet(str(tmp_path / "base")), typed, ["k"]))
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 1 and "SortMergeJoin" not in plan and "FullOuter" not in plan
    assert "BroadcastHashJoin" in plan and plan.count("from_json") == 1


def test_noop_report_reads_the_log_once(spark, typed):
    plan = executed(merge.noop_events(spark.range(40).selectExpr("id AS k"), typed, ["k"], stretch=10))
    assert plan.count("from_json") == 1 and "ReusedExchange" in plan


def test_key_only_changes_read_the_log_once(spark, typed):
    base = spark.range(40).selectExpr("id AS k", "'x' AS a", "1.0D AS b")
    plan = executed(merge.apply_key_only(base, typed, ["k"]))
    assert plan.count("from_json") == 1 and "HashAggregate" in plan and "SortAggregate" not in plan


def test_top_rows_are_cut_before_the_shuffle(spark):
    plan = executed(reconcile.latest_rows(spark.range(1000).selectExpr("id", "id % 3 AS g"), "id", ["g"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_orphan_check_scans_keys_only(spark, tmp_path):
    spark.range(500).selectExpr("id AS k", "'x' AS a", "id AS b").write.parquet(str(tmp_path / "t"))
    both = spark.read.parquet(str(tmp_path / "t"))
    plan = executed(reconcile.orphan_rows(both.select("k"), both, ["k"]))
    assert plan.count("ReadSchema: struct<k:bigint>") == 2


def test_counts_read_no_columns(spark, tmp_path):
    spark.range(500).selectExpr("id AS k", "'x' AS a").write.parquet(str(tmp_path / "t"))
    plan = executed(reconcile.count_tables({"t": spark.read.parquet(str(tmp_path / "t"))}))
    assert "ReadSchema: struct<>" in plan


def test_staged_log_prunes_tables(spark, tmp_path):
    raw = spark.createDataFrame([(i, envelope("c", f"t{i % 3}", None, {"k": i})) for i in range(30)], "seq bigint, value string")
    staged = stage_events(parse_events(raw), str(tmp_path / "staged"))
    one = staged.where(F.col("table") == "t1")
    assert "PartitionFilters: [isnotnull(table" in executed(one) and one.count() == 10


def test_counts_read_no_images_and_hash(spark, tmp_path):
    raw = spark.createDataFrame([(i, envelope("cudr"[i % 4], "t", {"k": i}, {"k": i})) for i in range(100)], "seq bigint, value string")
    raw.write.parquet(str(tmp_path / "log"))
    events = parse_changes(spark.read.parquet(str(tmp_path / "log")), images=False)[0]
    counts = progress.event_counts(events)
    assert "SortAggregate" not in executed(counts) and "map<" not in counts._jdf.queryExecution().optimizedPlan().toString()
    full = progress.event_counts(parse_changes(raw)[0])
    assert counts.collect() == full.collect()


def test_null_patterns_need_no_join_each(spark):
    """Rows are looked up by one join, however many combinations of columns the before images test."""
    columns = ["x", "y", "z", "w", "v", "u"]
    row = "struct<" + ",".join(f"{c}:bigint" for c in columns) + ">"
    nodes = spark.createDataFrame([(i, 7, (i, 0, 1, 2, 3, 4)) for i in range(5)], f"id bigint, after bigint, values {row}")

    def joins(patterns):
        rows = [(8 * k + 8, format(k % 63 + 1, "06b"), tuple((0, 0, 1, 2, 3, 4)[i] if bit == "1" else None for i, bit in enumerate(format(k % 63 + 1, "06b"))))
                for k in range(patterns)]
        found = unkeyed._successors(nodes, spark.createDataFrame(rows, f"code bigint, pattern string, was {row}"), columns, 1 << 20)
        assert found.where("id = 0").count() == 1
        return found._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(1) == joins(40) > 0


@pytest.fixture(scope="module")
def long_log(spark, tmp_path_factory):
    """30,000 updates, one per key, whose parsed columns are estimated at a small part of their text."""
    path = str(tmp_path_factory.mktemp("long") / "log")
    row = "named_struct('k', id, 'a', 'x', 'b', 1.0D)"
    spark.range(30_000).selectExpr("id AS seq", f"to_json(named_struct('payload', named_struct('op', 'u', 'source', "
                                   f"named_struct('table', 't'), 'before', {row}, 'after', {row}))) AS value").write.parquet(path)
    from tidemark.sources.changelog import decode_images
    return decode_images(parse_changes(spark.read.parquet(path))[0], SCHEMA)


@pytest.mark.parametrize("apply", [lambda *a: merge.apply_changes(*a, partial=False), merge.apply_partial, merge.apply_key_only])
def test_many_changes_are_not_broadcast(spark, long_log, tmp_path, apply):
    spark.range(40_000).selectExpr("id AS k", "'y' AS a", "2.0D AS b").write.parquet(str(tmp_path / "base"))
    state = apply(spark.read.parquet(str(tmp_path / "base")), long_log, ["k"])
    assert "Broadcast" not in executed(state) and state.count() == 40_000


def test_many_changes_without_a_key_are_not_broadcast(spark, long_log):
    changed = unkeyed.apply_unkeyed(None, long_log)
    missed = unkeyed.unkeyed_noop_events(None, long_log)
    assert "Broadcast" not in executed(changed) + executed(missed)
    assert changed.count() == missed.count() == 30_000


def test_borders_of_stretches_are_not_broadcast(long_log):
    assert "Broadcast" not in executed(merge.noop_events(None, long_log, ["k"], stretch=10))


def test_stretches_are_not_joined_into_few_partitions(long_log):
    """The sorts of a task would hold a share of the log that depends on the cores."""
    plan = executed(merge.noop_events(None, long_log, ["k"], stretch=10))
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan
