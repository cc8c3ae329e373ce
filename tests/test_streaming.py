import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.replay import envelope, replay_keyed
from tests.test_merge import SCHEMA, collected, random_log, rows
from tests.test_merge import typed_of
from tidemark.operators.progress import event_counts, merge_progress, progress, progress_of, progress_state
from tidemark.plans.replicate import TableSpec, counted_events, replicate
from tidemark.sources.bucket_store import BucketStore
from tidemark.sources.changelog import changelog_text, parse_changes
from tidemark.sources.table_store import TableStore, partial_rows
from tidemark.streaming.apply import run_stream, running_counts, stop_gracefully, stream_progress

SPECS = {"t": TableSpec(SCHEMA, ("k",))}


def with_position(line, seq):
    event = json.loads(line)
    event["payload"]["source"]["pos"] = seq
    return json.dumps(event)


def write_log(folder, name, events, first, bad=()):
    lines = [with_position(envelope(op, "t", b, a, "true" if op == "r" else "false"), first + i)
             for i, (op, b, a) in enumerate(events)]
    (folder / name).write_text("\n".join([*lines, *bad]) + "\n")


def start(spark, tmp_path, **options):
    raw = changelog_text(spark, str(tmp_path / "log"), streaming=True, max_files_per_trigger=1)
    return run_stream(spark, raw, SPECS, str(tmp_path / "store"), str(tmp_path / "checkpoint"),
                      order_field="pos", **options)


def stored(spark, tmp_path, partial=True):
    return BucketStore(spark, str(tmp_path / "store" / "t"), SCHEMA, ["k"], partial)


def files(store):
    """Data files by bucket folder."""
    folders = Path(store.path).glob("of-*/_bucket=*")
    return {f.name: sorted(x.name for x in f.glob("*.parquet")) for f in folders}


@pytest.mark.parametrize("partial", [False, True])
def test_batches_in_any_order_equal_the_log(spark, tmp_path, partial):
    rng = random.Random(21)
    events = random_log(rng, 150, 20, partial)
    base = {(k,): {"k": k, "a": "base", "b": float(k)} for k in range(10, 30)}
    want = rows(replay_keyed(base, events, ["k"]), ["k", "a", "b"])
    store = stored(spark, tmp_path, partial)
    store.load(spark.createDataFrame([(r["k"], r["a"], r["b"]) for r in base.values()], SCHEMA))
    typed = typed_of(spark, events, SCHEMA).cache()
    batches = [list(range(i, 150, 5)) for i in range(5)]
    rng.shuffle(batches)
    for batch in batches:
        store.apply(store.changes(typed.where(F.col("seq").isin(batch))))
    assert collected(store.read()) == want
    before = files(store)
    for batch in batches:
        assert store.apply(store.changes(typed.where(F.col("seq").isin(batch)))) == []
    assert files(store) == before and collected(store.read()) == want


def test_only_changed_buckets_are_written(spark, tmp_path):
    store = stored(spark, tmp_path)
    store.load(spark.range(400).selectExpr("id AS k", "'x' AS a", "1.0D AS b"))
    before = files(store)
    assert len(before) > 50
    typed = typed_of(spark, [("u", None, {"k": 7, "a": "y"}), ("d", {"k": 8}, None), ("c", None, {"k": 1000, "b": 2})], SCHEMA)
    touched = store.apply(store.changes(typed))
    after = files(store)
    assert 1 <= len(touched) <= 3
    assert {f for f in after if after[f] != before.get(f)} == {f"_bucket={b}" for b in touched}
    got = {r.k: (r.a, r.b) for r in store.read().where("k IN (7, 8, 9, 1000)").collect()}
    assert got == {7: ("y", 1.0), 9: ("x", 1.0), 1000: (None, 2.0)}
    # Events before those that were applied come too late.
    late = typed_of(spark, [("u", None, {"k": 7, "a": "late"}), ("c", None, {"k": 8, "a": "late"})], SCHEMA).withColumn("seq", F.col("seq") - 1)
    assert store.apply(store.changes(late)) == []
    with pytest.raises(ValueError):
        BucketStore(spark, store.path, SCHEMA, ["k"], buckets=8).read()


def test_tombstones_go_after_the_horizon(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=1, horizon=5)
    for position, (op, before, after) in enumerate([("c", None, {"k": 1}), ("d", {"k": 1}, None), ("c", None, {"k": 2})]):
        store.apply(store.changes(typed_of(spark, [(op, before, after)], SCHEMA).withColumn("seq", F.lit(position).cast("bigint"))))
    assert {r.k for r in store.state().collect()} == {1, 2}
    store.apply(store.changes(typed_of(spark, [("c", None, {"k": 3})], SCHEMA).withColumn("seq", F.lit(20).cast("bigint"))))
    assert {r.k for r in store.state().collect()} == {2, 3}


@pytest.mark.parametrize("partial", [False, True])
def test_orphans_of_a_bucketed_table(spark, tmp_path, partial):
    store = stored(spark, tmp_path, partial)
    store.load(spark.range(50).selectExpr("id AS k", "'x' AS a", "1.0D AS b"))
    source = spark.range(40).selectExpr("cast(id AS decimal(10,0)) AS k")
    assert store.remove_orphans(source) == 10 and store.remove_orphans(source) == 0
    assert store.read().count() == 40


def test_reordered_stream_equals_batch_and_tells_its_progress(spark, tmp_path):
    """Files of a log in the wrong order, one per micro-batch."""
    (tmp_path / "log").mkdir()
    events = random_log(random.Random(13), 120, 15, True)
    for name, part in (("a.txt", 2), ("b.txt", 0), ("c.txt", 3), ("d.txt", 1)):
        write_log(tmp_path / "log", name, events[part * 30:part * 30 + 30], part * 30, ["{bad"])
        stamp = 1_700_000_000 + ord(name[0])
        os.utime(tmp_path / "log" / name, (stamp, stamp))
    assert stop_gracefully(start(spark, tmp_path), 240)
    assert collected(stored(spark, tmp_path).read()) == rows(replay_keyed({}, events, ["k"]), ["k", "a", "b"])
    good, _ = parse_changes(changelog_text(spark, str(tmp_path / "log")), order_field="pos")
    totals = spark.createDataFrame([("t", 40)], "table string, total bigint")
    want = progress(counted_events(good, SPECS), totals=totals)
    got = stream_progress(spark, str(tmp_path / "store"), str(tmp_path / "checkpoint"), totals=totals)
    assert collected(got.drop("last_event")) == collected(want) and want.count() == 1


def test_progress_states_merge_in_any_order(spark):
    good, _ = parse_changes(spark.createDataFrame([(i, envelope("rcud"[i * 7 % 4], f"t{i % 3}", {"k": i}, {"k": i}, ["true", "last", "false"][i % 3]))
                                                   for i in range(60)], "seq bigint, value string"))
    parts = [progress_state(good.where(F.col("seq") % 4 == i)) for i in (2, 0, 3, 1)]
    got = progress_of(merge_progress(merge_progress(*parts[:2]), *parts[2:])).drop("last_event")
    assert collected(got) == collected(progress(good))


def test_stream_equals_batch_and_survives_restart(spark, tmp_path):
    (tmp_path / "log").mkdir()
    events = random_log(random.Random(11), 120, 20, True)
    write_log(tmp_path / "log", "a.txt", events[:40], 0, ["{bad"])
    write_log(tmp_path / "log", "b.txt", events[40:80], 40)
    assert stop_gracefully(start(spark, tmp_path), 120)
    store = stored(spark, tmp_path)
    assert collected(store.read()) == rows(replay_keyed({}, events[:80], ["k"]), ["k", "a", "b"])
    write_log(tmp_path / "log", "c.txt", events[80:], 80)
    assert stop_gracefully(start(spark, tmp_path), 120)
    want = rows(replay_keyed({}, events, ["k"]), ["k", "a", "b"])
    assert collected(store.read()) == want
    tables, rejected = replicate(changelog_text(spark, str(tmp_path / "log")), SPECS, order_field="pos")
    assert collected(tables["t"]) == want
    assert [r.reason for r in rejected.collect()] == ["not_json"]
    staged, rejected = replicate(changelog_text(spark, str(tmp_path / "log")), SPECS, order_field="pos", staging=str(tmp_path / "staged"))
    assert collected(staged["t"]) == want and [r.reason for r in rejected.collect()] == ["not_json"]
    assert spark.read.parquet(str(tmp_path / "store" / "_rejected" / "*")).count() == 1


def test_repeated_batch_is_skipped(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.write(spark.range(3), "x-0")
    assert store.has("x-0") and not store.has("x-1")
    (tmp_path / "t" / "v-000000000001-x-1").mkdir()  # an attempt that never finished
    assert store.read().count() == 3
    store.write(spark.range(5), "x-1")
    assert [v.tag for v in store.versions()] == ["x-0", "x-1"] and store.read().count() == 5


def test_orphans_are_removed_when_streaming_starts(spark, tmp_path):
    (tmp_path / "log").mkdir()
    store = stored(spark, tmp_path)
    store.load(spark.createDataFrame([(1, "old", 1.0), (77, "zombie", 0.0)], SCHEMA))
    write_log(tmp_path / "log", "a.txt", [("r", None, {"k": 1, "a": "n", "b": 2})], 0)
    asked = []

    def source():
        asked.append(1)
        return spark.createDataFrame([(1,), (2,)], "k int")

    assert stop_gracefully(start(spark, tmp_path, sources={"t": source}), 120)
    assert not asked and {r.k for r in store.read().collect()} == {1, 77}
    write_log(tmp_path / "log", "b.txt", [("c", None, {"k": 2, "a": "n", "b": 2})], 1)
    write_log(tmp_path / "log", "c.txt", [("u", None, {"k": 2, "a": "m", "b": 2})], 2)
    assert stop_gracefully(start(spark, tmp_path, sources={"t": source}), 120)
    assert len(asked) == 1 and collected(store.read()) == [(1, "n", 2.0), (2, "m", 2.0)]
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "store" / "_removed" / "*")).collect()] == [("t", 1)]


def test_running_counts_equal_batch_counts(spark, tmp_path):
    (tmp_path / "log").mkdir()
    events = random_log(random.Random(4), 90, 10, False)
    for i, name in enumerate(("a.txt", "b.txt", "c.txt")):
        write_log(tmp_path / "log", name, events[i * 30:(i + 1) * 30], i * 30)
    raw = changelog_text(spark, str(tmp_path / "log"), streaming=True, max_files_per_trigger=1)
    query = (running_counts(raw, order_field="pos").writeStream.format("memory").queryName("counts")
             .outputMode("complete").trigger(availableNow=True).start())
    assert stop_gracefully(query, 120)
    good, _ = parse_changes(changelog_text(spark, str(tmp_path / "log")), order_field="pos")
    assert collected(spark.table("counts")) == collected(event_counts(good))


def test_unreadable_events_are_not_counted(spark):
    lines = [envelope("c", "t", None, {"k": 1, "b": 1}), envelope("c", "t", None, {"k": 2, "b": "?"}),
             envelope("c", "t", None, None), envelope("x", "t", None, {"k": 3}), envelope("d", "other", None, None)]
    raw = spark.createDataFrame(list(enumerate(lines)), "seq bigint, value string")
    good, _ = parse_changes(raw)
    got = {r.table: (r.inserts, r.deletes, r.phase) for r in progress(counted_events(good, SPECS)).collect()}
    assert got == {"t": (2, 0, "CDC"), "other": (0, 1, "CDC")}


def test_running_counts_follow_the_rule_of_the_batch_plan(spark, tmp_path):
    lines = [{"op": "c", "after": {"k": 1, "n": 5}}, {"op": "c", "after": {"n": 5}}, {"op": "c", "after": {"k": 2, "n": "word"}}, {"op": "d", "before": {"k": 1}},
             {"op": "d"}, {"op": "u", "after": {"k": 3, "n": None}}]
    text = [json.dumps({"payload": {**x, "source": {"table": t, "pos": i}}}) for t in ("t", "other") for i, x in enumerate(lines)]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text("\n".join(text))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.IntegerType())])
    specs = {"t": TableSpec(schema, keys=("k",))}
    read = {"order_field": "pos"}
    batch = event_counts(counted_events(parse_changes(spark.read.text(str(tmp_path / "log")), **read)[0], specs))
    stream = running_counts(spark.readStream.text(str(tmp_path / "log")), specs=specs, **read)
    query = stream.writeStream.format("memory").queryName("counts_by_rule").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    numbers = ["table", "inserts", "updates", "deletes"]
    got = sorted(map(tuple, spark.table("counts_by_rule").select(*numbers).collect()))
    assert got == sorted(map(tuple, batch.select(*numbers).collect())) == [("other", 3, 1, 2), ("t", 1, 1, 2)]


def test_tables_without_events_get_no_new_version(spark, tmp_path):
    (tmp_path / "log").mkdir()
    specs = {"t": TableSpec(SCHEMA), "quiet": TableSpec(SCHEMA)}
    quiet = TableStore(spark, str(tmp_path / "store" / "quiet"))
    quiet.write(spark.createDataFrame([(5, "z", 1.0)], SCHEMA), "before")
    for i in range(3):
        write_log(tmp_path / "log", f"{i}.txt", [("c", None, {"k": i, "a": "n", "b": 2})], i)
    raw = changelog_text(spark, str(tmp_path / "log"), streaming=True, max_files_per_trigger=1)
    assert stop_gracefully(run_stream(spark, raw, specs, str(tmp_path / "store"), str(tmp_path / "checkpoint"), order_field="pos"), 120)
    assert [v.tag for v in quiet.versions()] == ["before"]
    assert TableStore(spark, str(tmp_path / "store" / "t")).read().count() == 3


@pytest.mark.parametrize(("mode", "want"), [("initial", {0, 1}), ("never", {1}), ("initial_only", {0})])
def test_snapshot_modes_of_a_stream(spark, tmp_path, mode, want):
    (tmp_path / "log").mkdir()
    write_log(tmp_path / "log", "a.txt", [("r", None, {"k": 0, "a": "n", "b": 2}), ("c", None, {"k": 1, "a": "n", "b": 2})], 0)
    assert stop_gracefully(start(spark, tmp_path, mode=mode), 120)
    assert {r.k for r in stored(spark, tmp_path).read().collect()} == want


def test_merge_source_of_partial_images(spark):
    """The MERGE of `merge_partial_statement`, acted out row by row, gives what the replay gives."""
    events = random_log(random.Random(5), 150, 15, True)
    base = {(k,): {"k": k, "a": "base", "b": float(k)} for k in range(8, 20)}
    table = {k: dict(v) for k, v in base.items()}
    for s in partial_rows(typed_of(spark, events, SCHEMA), ["k"], ["k", "a", "b"]).collect():
        held = table.get((s.k,))
        if held is not None and not s._alive:
            del table[s.k,]
        elif held is not None:
            for c in ("a", "b"):
                held[c] = s[c] if s[f"_has_{c}"] else None if s._removed else held[c]
        elif s._alive:
            table[s.k,] = {"k": s.k, "a": s.a, "b": s.b}
    assert sorted(map(str, rows(table, ["k", "a", "b"]))) == sorted(map(str, rows(replay_keyed(base, events, ["k"]), ["k", "a", "b"])))
