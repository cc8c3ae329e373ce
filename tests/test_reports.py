"""Progress, reconciliation, checks: golden values and edge cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.replay import envelope
from tests.test_merge import collected
from tidemark.operators import checks, progress, reconcile
from tidemark.operators.catalog import CATALOG_SCHEMA
from tidemark.sources.changelog import parse_changes
from tidemark.sources.snapshot import after_position, base_for_mode, effective_mode, events_for_mode, snapshot_scan
from tidemark.operators.merge import apply_changes
from tidemark.operators.reconcile import latest_rows, remove_orphans, remove_orphans_observed


def events(spark, log):
    """log: (op, table, snapshot flag)"""
    rows = [(i, datetime(2024, 1, 1, 0, 0, i % 60), envelope(op, t, {"id": i}, {"id": i}, flag)) for i, (op, t, flag) in enumerate(log)]
    return parse_changes(spark.createDataFrame(rows, "seq bigint, at timestamp_ntz, value string"))[0]


def phases(frame):
    return {r.table: r.phase for r in frame.collect()}


def test_phases(spark):
    registered = spark.createDataFrame([("empty",), ("a",)], "table string")
    snapshot = [("r", "a", "true"), ("r", "b", "last")]
    assert phases(progress.progress(events(spark, snapshot), registered)) == {
        "a": "SNAPSHOT", "b": "SNAPSHOT", "empty": "INITIALIZING"}
    # An unknown operation counts as nothing, but it does show that streaming has begun.
    log = snapshot + [("t", "c", "false"), ("r", "a", "true")]
    assert phases(progress.progress(events(spark, log), registered)) == {"a": "SNAPSHOT", "b": "SNAPSHOT", "empty": "CDC"}
    assert phases(progress.progress(events(spark, log + [("d", "a", None)]))) == {"a": "CDC", "b": "SNAPSHOT"}
    nothing = progress.progress(events(spark, log).where("false"), registered)
    assert phases(nothing) == {"a": "INITIALIZING", "empty": "INITIALIZING"}


def test_counts_and_totals(spark):
    log = [("r", "a", "true")] * 3 + [("c", "a", "false"), ("u", "a", None), ("u", "b", ""), ("d", "b", "false"), ("x", "b", "false")]
    per_table = progress.progress(events(spark, log), time_col="at")
    got = {r.table: (r.snapshot_rows, r.inserts, r.updates, r.deletes, r.changes, r.last_event.second) for r in per_table.collect()}
    assert got == {"a": (3, 1, 1, 0, 2, 4), "b": (0, 0, 1, 1, 2, 6)}
    assert {r.table: r.changes for r in progress.with_overall(per_table).collect()} == {"a": 2, "b": 2, "TOTAL": 4}
    assert tuple(progress.report_header(per_table).first()) == (2, 4)


def test_snapshot_share_and_labels(spark):
    df = spark.createDataFrame([(50, 100), (0, -1), (7, 0), (500, 1000), (12450, 12450), (42, -1)], "n bigint, t bigint")
    got = df.select(progress.snapshot_percent(F.col("n"), F.col("t")).alias("p"), progress.snapshot_label(F.col("n"), F.col("t")).alias("l")).collect()
    assert [tuple(r) for r in got] == [(50.0, "50.0% (50/100)"), (-1.0, "0 rows"), (-1.0, "7 rows"), (50.0, "50.0% (500/1,000)"),
                                       (100.0, "100.0% (12,450/12,450)"), (-1.0, "42 rows")]
    ages = spark.createDataFrame([(v,) for v in (500, 999, 3500, 59999, 150000, 7200100)], "ms bigint")
    assert [r.x for r in ages.select(progress.elapsed_label(F.col("ms")).alias("x")).collect()] == [
        "500ms", "999ms", "3s ago", "59s ago", "2m ago", "2h ago"]


def test_status_report(spark):
    log = [("r", "b", "true"), ("c", "a", "false")]
    registered = spark.createDataFrame([("z",)], "table string")
    totals = spark.createDataFrame([("b", 4)], "table string, total bigint")
    report = progress.status_report(progress.progress(events(spark, log), registered, totals, time_col="at"),
                                    F.lit(datetime(2024, 1, 1, 0, 1)).cast("timestamp_ntz"))
    assert [tuple(r) for r in report.collect()] == [("a", "CDC", "0 rows", 1, 0, 0, "59s ago"),
                                                    ("b", "SNAPSHOT", "25.0% (1/4)", 0, 0, 0, "1m ago"),
                                                    ("z", "CDC", "0 rows", 0, 0, 0, None)]


@pytest.mark.parametrize("log,want", [
    ([("r", "a", "true"), ("r", "a", "last"), ("c", "a", "false")], 1),
    ([("r", "a", "true"), ("c", "b", None)], 1), ([("r", "a", "true")], None), ([("t", "a", "")], 0)])
def test_cleanup_trigger(spark, log, want):
    assert progress.cleanup_trigger(events(spark, log)).first().position == want


def test_modes(spark):
    log = events(spark, [("r", "a", "true"), ("c", "a", "false"), ("d", "a", "false")])
    assert [events_for_mode(log, m).count() for m in ("initial", "always", "never", "schema_only", "initial_only")] == [3, 3, 2, 2, 1]
    assert effective_mode("kingbase", "initial") == "initial_only" and effective_mode("mysql", "never") == "never"
    with pytest.raises(ValueError):
        effective_mode("mysql", "sometimes")
    rows = spark.createDataFrame([(1, "x")], "k bigint, a string")
    assert base_for_mode(spark, "schema_only", rows.schema).count() == 0
    assert base_for_mode(spark, "never", rows.schema, snapshot=rows) is None
    assert base_for_mode(spark, "initial", rows.schema, snapshot=rows).count() == 1
    assert after_position(log, 1).count() == 1
    assert collected(apply_changes(None, snapshot_scan(rows, "t"), ["k"])) == [(1, "x")]


def test_compare_counts(spark):
    source = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", 1)], "table string, rows bigint")
    target = spark.createDataFrame([("a", 10), ("b", 5), ("c", 4), ("d", 9)], "table string, rows bigint")
    got = {r.table: (r.lag, r.status) for r in reconcile.compare_counts(source, target).collect()}
    assert got == {"a": (0, "synced"), "b": (5, "behind"), "c": (6, "far behind"), "d": (-8, "behind"), "TOTAL": (3, "behind")}
    only = reconcile.compare_counts(source, target.where("table = 'a'")).where("table = 'TOTAL'").first()
    assert (only.lag, only.status) == (21, "far behind")


def test_counts_include_empty_tables(spark):
    got = reconcile.reconcile_counts({"e": spark.range(0), "x": spark.range(3)}, {"e": spark.range(0), "x": spark.range(3)})
    assert {r.table: (r.source_rows, r.status) for r in got.collect()} == {"e": (0, "synced"), "x": (3, "synced"), "TOTAL": (3, "synced")}


def test_composite_orphans_compare_whole_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x int, y string")
    source = spark.createDataFrame([(1, "a"), (2, "b")], "x bigint, y string")
    assert collected(reconcile.orphan_rows(target, source, ["x", "y"])) == [(1, "b"), (2, "a")]
    assert collected(reconcile.remove_orphans(target, source, ["x", "y"])) == [(1, "a")]


def test_orphan_totals_report_each_table_by_itself(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    some, dates = spark.createDataFrame([(2,)], "k bigint"), spark.createDataFrame([("x",)], "k string").selectExpr("true AS k")
    got = reconcile.orphan_totals(spark, {
        "a": (keys, some, ["k"]), "TOTAL": (keys, keys, ["k"]), "unkeyed": (keys, keys, []),
        "gone": (lambda: spark.read.parquet("/nowhere/at/all"), keys, ["k"]), "odd": (keys, dates, ["k"])}).collect()
    by = [(r.table, r.orphans, r.status.split(":")[0]) for r in got]
    want = [("TOTAL", 0, "ok"), ("TOTAL", 2, "incomplete"), ("a", 2, "ok"), ("gone", None, "failed"), ("odd", None, "failed")]
    assert sorted(by, key=str) == sorted(want, key=str)


def test_rates_and_trend(spark):
    totals = [0, 10, 30, 30, 45, 50, 100, 160]
    samples = spark.createDataFrame(list(enumerate(totals)), "sample bigint, total bigint")
    assert tuple(reconcile.source_rate(samples, 2.0).first()) == (7, (160 - 30) / 10.0)
    assert tuple(reconcile.source_rate(samples.where("sample < 3"), 1.0).first()) == (2, 15.0)
    assert reconcile.source_rate(samples.where("sample = 0"), 1.0).first().rate is None
    lags = [(i, v) for i, v in enumerate([99] * 5 + [0, -4, 7, 14, 3] + [1] * 15)]
    got = {r.sample: r.level for r in reconcile.lag_trend(spark.createDataFrame(lags, "sample bigint, lag bigint")).collect()}
    assert len(got) == 20 and [got[i] for i in range(5, 11)] == [0, 0, 3, 7, 1, 0]
    flat = spark.createDataFrame([(i, 0) for i in range(3)], "sample bigint, lag bigint")
    assert {r.level for r in reconcile.lag_trend(flat).collect()} == {0}


def test_latest_rows_diff(spark):
    def side(ids):
        return spark.createDataFrame([("t", i, f"v{i}") for i in ids], "table string, id bigint, v string")
    got = reconcile.latest_rows_diff(side([1, 2, 3, 4, 5]), side([1, 2, 3, 5, 9]), "id", ["table"])
    assert sorted((r.id, r.v, r.side) for r in got.collect()) == [
        (3, "v3", "both"), (4, "v4", "source only"), (5, "v5", "both"), (9, "v9", "target only")]
    assert [r.id for r in reconcile.latest_rows(side([4, 9, 1, 7]), "id").orderBy("rank").collect()] == [9, 7, 4]


def catalog(spark, *tables):
    return spark.createDataFrame([(t, c, "INT", 0, 0, True, False, i, None) for t in tables for i, c in enumerate("xy")], CATALOG_SCHEMA)


def test_table_checks(spark):
    required = spark.createDataFrame([("users", 0), ("orders", 1)], "table string, position int")
    both, one = catalog(spark, "users", "orders", "other"), catalog(spark, "users")

    def run(source, target, **options):
        return {r.id: (r.status, r.message, list(r.details)) for r in checks.table_checks(required, source, target, **options).collect()}

    assert run(both, both) == {
        "tables.source": ("PASS", "All 2 configured table(s) found in source", ["users (2 columns)", "orders (2 columns)"]),
        "tables.target": ("PASS", "All 2 configured table(s) already exist in target", [])}
    got = run(one, one)
    assert got["tables.source"] == ("FAIL", "Missing in source: [orders]", ["not found: orders"])
    assert got["tables.target"] == ("WARN", "1 table(s) missing in target (will be created by schema sync)", ["not in target: orders"])
    assert run(both, one, schema_sync=False)["tables.target"][:2] == ("FAIL", "1 table(s) missing in target — schema sync is OFF")
    assert run(both, both, target_up=False)["tables.target"][:2] == ("WARN", "Target table check skipped (connection unavailable)")
    empty = checks.table_checks(required.where("false"), both, both).collect()
    assert [(r.id, r.status) for r in empty] == [("tables", "PASS")]
    # The table selection is exact, so another spelling is not found.
    assert [r.table for r in checks.missing_tables(required, catalog(spark, "Users", "orders")).collect()] == ["users"]


def test_check_summary(spark):
    rows = spark.createDataFrame([("PASS",), ("WARN",), ("PASS",)], "status string")
    assert tuple(checks.check_summary(rows).first()) == (3, 2, 1, 0, 0)
    failed = rows.unionByName(spark.createDataFrame([("FAIL",)], "status string"))
    assert tuple(checks.check_summary(failed).first()) == (4, 2, 1, 1, 1)


def test_cleanup_tells_how_many_rows_went_by_one_join(spark):
    target = spark.createDataFrame([(i, "x") for i in [*range(100), None]], "k bigint, a string")
    source = spark.range(60).unionByName(spark.range(10)).selectExpr("cast(id AS decimal(12,0)) AS k")
    cleaned, removed = remove_orphans_observed(target, source, ["k"])
    assert len(cleaned.collect()) == 60 and removed() == 41
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert sorted(cleaned.collect()) == sorted(remove_orphans(target, source, ["k"]).collect())


def test_pruned_orphan_check_joins_only_what_differs(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id AS k", "id % 7 AS j", "'x' AS a")
    extra = spark.createDataFrame([(5000, 1, "left over"), (None, 2, "no key"), (3, None, "half a key")], "k bigint, j bigint, a string")
    rows.unionByName(extra).write.parquet(str(tmp_path / "t"))
    rows.select(F.col("k").cast("decimal(12,0)").alias("k"), "j").unionByName(
        spark.createDataFrame([(None, 2), (9000, 9)], "k bigint, j bigint").select(F.col("k").cast("decimal(12,0)"), "j")).write.parquet(str(tmp_path / "s"))
    target, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    got = reconcile.orphan_rows_pruned(target, source, ["k", "j"], buckets=256)
    assert collected(got) == collected(reconcile.orphan_rows(target, source, ["k", "j"])) and got.count() == 3
    differing = reconcile.differing_buckets(*reconcile.key_pairs(target, source, ["k", "j"]), 2, 256)
    assert differing.count() <= 3
    same = reconcile.orphan_rows_pruned(rows, rows.repartition(3), ["k", "j"])
    assert same.count() == 0


def test_latest_rows_break_ties_by_the_other_columns(spark):
    rows = spark.createDataFrame([(1, 5, "c"), (2, 5, "b"), (3, 5, None), (4, 9, "a"), (5, 1, "z")], "id int, at int, a string").repartition(5)
    want = [(4, 1), (1, 2), (2, 3)]
    assert sorted((r.id, r["rank"]) for r in latest_rows(rows, "at").collect()) == sorted(want)
    per = latest_rows(rows.withColumn("g", F.lit("g")), "at", ["g"])
    assert sorted((r.id, r["rank"]) for r in per.collect()) == sorted(want)
