import random

import pytest
from pyspark.sql import types as T

from tests.replay import envelope, replay_bag, replay_keyed
from tidemark.operators.merge import apply_changes, apply_key_only, apply_partial, noop_events, rejected_events
from tidemark.operators.unkeyed import apply_unkeyed, rejected_unkeyed, unkeyed_noop_events
from tidemark.sources.changelog import decode_images, parse_changes

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()),
                       T.StructField("b", T.DoubleType())])
BAG = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])


def typed_of(spark, events, schema):
    raw = spark.createDataFrame([(i, envelope(op, "t", b, a)) for i, (op, b, a) in enumerate(events)],
                                "seq bigint, value string")
    good, _ = parse_changes(raw)
    return decode_images(good, schema)


def random_log(rng, n, keys, partial):
    events = []
    for _ in range(n):
        k = 0 if rng.random() < 0.3 else rng.randrange(keys)
        op = rng.choice("rccuuud")
        if op == "d":
            events.append((op, {"k": k}, None))
            continue
        after = {"k": k, "a": rng.choice(["p", "q", None]), "b": rng.choice([1.5, 2.0, None])}
        if partial:
            after = {c: v for c, v in after.items() if c == "k" or rng.random() < 0.6}
        events.append((op, None, after))
    return events


def rows(table, columns):
    return sorted([tuple(r.get(c) for c in columns) for r in table.values()], key=repr)


def collected(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("with_base", [False, True])
def test_keyed_replay_equals_fold(spark, seed, partial, with_base):
    rng = random.Random(seed)
    events = random_log(rng, 400, 40, partial)
    base = {(k,): {"k": k, "a": "base", "b": float(k)} for k in range(20, 60)} if with_base else {}
    base_df = spark.createDataFrame([(r["k"], r["a"], r["b"]) for r in base.values()], SCHEMA) if with_base else None
    got = apply_changes(base_df, typed_of(spark, events, SCHEMA), ["k"], partial=partial)
    assert collected(got) == rows(replay_keyed(base, events, ["k"]), ["k", "a", "b"])


def test_composite_key(spark):
    rng = random.Random(5)
    events = random_log(rng, 300, 12, False)
    events = [(op, b if b is None else {**b, "a": rng.choice("pq")}, a if a is None else {**a, "a": rng.choice("pq")})
              for op, b, a in events]
    got = apply_changes(None, typed_of(spark, events, SCHEMA), ["k", "a"], partial=False)
    assert collected(got) == rows(replay_keyed({}, events, ["k", "a"]), ["k", "a", "b"])


def test_replaying_twice_changes_nothing(spark):
    events = random_log(random.Random(9), 200, 20, True)
    once = apply_partial(None, typed_of(spark, events, SCHEMA), ["k"])
    twice = apply_partial(once, typed_of(spark, events, SCHEMA), ["k"])
    assert collected(once) == collected(twice)


def test_key_only_changes(spark):
    events = [("c", None, {"k": 1}), ("c", None, {"k": 9}), ("d", {"k": 2}, None), ("d", {"k": 3}, None),
              ("u", None, {"k": 3}), ("c", None, {"k": 7}), ("d", {"k": 7}, None)]
    base = {(k,): {"k": k, "a": "base", "b": 1.0} for k in (1, 2, 3, 4)}
    base_df = spark.createDataFrame([(k, "base", 1.0) for k in (1, 2, 3, 4)], SCHEMA)
    got = apply_key_only(base_df, typed_of(spark, events, SCHEMA), ["k"])
    want = rows(replay_keyed(base, events, ["k"]), ["k", "a", "b"])
    assert collected(got) == want
    assert collected(apply_partial(base_df, typed_of(spark, events, SCHEMA), ["k"])) == want


def test_staff_end_to_end(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("dept", T.StringType()), T.StructField("score", T.IntegerType())])
    seed = [(1, "Alice", "Engineering", 90), (2, "Bob", "Marketing", 75), (3, "Carol", "Engineering", 85)]
    named = [dict(zip(("id", "name", "dept", "score"), r)) for r in seed]
    events = [("r", None, r) for r in named]
    events += [("c", None, {"id": 4, "name": "Dave", "dept": "HR", "score": 70})]
    assert apply_changes(None, typed_of(spark, events, schema), ["id"]).count() == 4
    events += [("u", named[0], {**named[0], "score": 95}), ("d", named[1], None)]
    got = apply_changes(None, typed_of(spark, events, schema), ["id"])
    assert collected(got) == [(1, "Alice", "Engineering", 95), (3, "Carol", "Engineering", 85), (4, "Dave", "HR", 70)]


@pytest.mark.parametrize("stretch", [3, 1 << 20])
def test_noop_deletes(spark, stretch):
    rng = random.Random(3)
    events = random_log(rng, 300, 15, False)
    events[7] = ("d", None, None)
    base = {k for k in range(0, 15, 2)}
    alive, want = set(base), []
    for i, (op, before, after) in enumerate(events):
        if op == "d" and before is None:
            want.append((i, None, "no_before_image"))
        elif op == "d":
            if before["k"] not in alive:
                want.append((i, before["k"], "no_row"))
            alive.discard(before["k"])
        else:
            alive.add(after["k"])
    base_df = spark.createDataFrame([(k, "x", 1.0) for k in base], SCHEMA)
    got = noop_events(base_df, typed_of(spark, events, SCHEMA), ["k"], stretch=stretch)
    assert collected(got) == sorted(want, key=repr)


def test_rejected_events(spark):
    events = [("c", None, {"k": 1, "b": "no number"}), ("c", None, {"a": "no key"}), ("d", {"a": "x"}, None),
              ("d", {"k": 5, "b": "not needed"}, None), ("c", None, {"k": 6, "b": 1})]
    typed = typed_of(spark, events, SCHEMA)
    assert collected(rejected_events(typed, ["k"])) == [
        (0, "c", "unreadable_value"), (1, "c", "incomplete_key"), (2, "d", "incomplete_key")]
    assert [r.k for r in apply_changes(None, typed, ["k"]).collect()] == [6]


def random_bag_log(rng, n, wildcards):
    def value():
        x = 0 if rng.random() < 0.4 else rng.randrange(4)
        return {"x": x, "y": rng.choice("pq") if not wildcards or rng.random() < 0.8 else None}
    events = []
    for _ in range(n):
        op = rng.choice("ccuuuud")
        before = value() if op in "ud" else None
        if wildcards and before and rng.random() < 0.3:
            before["x"] = None
        if op == "u" and rng.random() < 0.05:
            before = None
        events.append((op, before, None if op == "d" else value()))
    return events


@pytest.mark.parametrize("seed,wildcards,with_base,stretch", [
    (1, False, True, 1 << 20), (2, False, False, 7), (3, True, True, 5), (4, True, False, 1 << 20), (6, True, True, 1)])
def test_bag_replay_equals_fold(spark, seed, wildcards, with_base, stretch):
    rng = random.Random(seed)
    events = random_bag_log(rng, 60, wildcards)
    base = [(rng.randrange(4), rng.choice(["p", "q", None])) for _ in range(25)] if with_base else []
    base_df = spark.createDataFrame(base, BAG) if with_base else None
    typed = typed_of(spark, events, BAG)
    want, missed = replay_bag(base, events, ["x", "y"])
    assert collected(apply_unkeyed(base_df, typed, stretch=stretch)) == sorted(want, key=repr)
    assert collected(unkeyed_noop_events(base_df, typed, stretch=stretch)) == sorted(missed, key=repr)


WIDE = T.StructType([T.StructField(c, T.LongType()) for c in ("x", "y", "z", "w")])


def partial_bag_log(rng, n, tests):
    """Updates that carry some columns. Before images test a random part of `tests`; the others are payload."""
    def some(columns, least):
        kept = [c for c in columns if rng.random() < 0.6]
        return kept if len(kept) >= least else list(columns)
    events = []
    for _ in range(n):
        op = rng.choice("cuuuuuud")
        before = {c: rng.randrange(3) if rng.random() < 0.85 else None for c in some(tests, 1)} if op in "ud" else None
        after = None if op == "d" else {c: rng.choice([0, 1, 2, 2, None]) for c in some(WIDE.names, 1)}
        events.append((op, before, after))
    return events


@pytest.mark.parametrize("seed,tests,with_base,stretch", [
    (1, "x", True, 1 << 20), (2, "xy", True, 4), (3, "xyzw", True, 1 << 20), (4, "xyz", False, 1 << 20), (5, "xyzw", False, 3), (6, "y", False, 1 << 20)])
def test_bag_replay_with_partial_images_equals_fold(spark, seed, tests, with_base, stretch):
    rng = random.Random(seed)
    events = partial_bag_log(rng, 45, tests)
    base = [tuple(rng.choice([0, 1, 2, None]) for _ in WIDE.names) for _ in range(20)] if with_base else []
    base_df = spark.createDataFrame(base, WIDE) if with_base else None
    typed = typed_of(spark, events, WIDE)
    want, missed = replay_bag(base, events, WIDE.names)
    assert collected(apply_unkeyed(base_df, typed, stretch=stretch)) == sorted(want, key=repr)
    assert collected(unkeyed_noop_events(base_df, typed, stretch=stretch)) == sorted(missed, key=repr)


def test_partial_updates_of_a_single_payload_column(spark):
    """A row found by x alone, changed in y and z by turns: the way is a chain, its columns come from different updates."""
    events = [("c", None, {"x": 1, "y": 0, "z": 0, "w": 9})]
    events += [("u", {"x": 1}, {"y" if i % 2 else "z": i}) for i in range(1, 20)]
    assert collected(apply_unkeyed(None, typed_of(spark, events, WIDE))) == [(1, 19, 18, 9)]


def test_inserted_rows_that_depend_on_one_another(spark):
    """Whether an update inserts its row depends on whether the one before did, and so on."""
    events = []
    for i in range(6):
        events.append(("u", {"x": i % 3, "y": 1}, {"x": (i + 1) % 3, "z": i}))
        events.append(("u", {"x": (i + 1) % 3, "z": i}, {"y": 1}))
    want, missed = replay_bag([], events, WIDE.names)
    typed = typed_of(spark, events, WIDE)
    assert collected(apply_unkeyed(None, typed)) == sorted(want, key=repr)
    assert collected(unkeyed_noop_events(None, typed)) == sorted(missed, key=repr)


def test_long_update_chain(spark):
    events = [("c", None, {"x": 0, "y": "p"})] + [("u", {"x": i, "y": "p"}, {"x": i + 1, "y": "p"}) for i in range(40)]
    assert collected(apply_unkeyed(None, typed_of(spark, events, BAG))) == [(40, "p")]


def test_large_counts_are_spread(spark):
    from tidemark.operators.unkeyed import _repeat_rows
    counted = spark.createDataFrame([((1, "p"), 25), ((2, "q"), 3), ((3, "z"), 0)],
                                    "row struct<x:bigint,y:string>, count bigint")
    got = _repeat_rows(counted, ["x", "y"], chunk=4)
    assert got.groupBy("x").count().orderBy("x").collect() == [(1, 25), (2, 3)]


def test_empty_images_do_nothing(spark):
    events = [("c", None, {}), ("u", None, {}), ("c", None, {"x": 1, "y": None}), ("u", {}, {})]
    assert collected(apply_unkeyed(None, typed_of(spark, events, BAG))) == [(1, None)]


def test_unkeyed_rejects(spark):
    events = [("u", {"x": 1, "y": "p"}, {"x": 2}), ("d", {"x": None, "y": None}, None), ("c", None, {"x": "?"})]
    typed = typed_of(spark, events, BAG)
    assert collected(rejected_unkeyed(typed, ["x", "y"])) == [
        (1, "d", "no_usable_before"), (2, "c", "unreadable_value")]


def test_later_rounds_leave_out_what_is_settled(spark, monkeypatch):
    """A run of open updates takes a round each; the rest of the log is not dealt out again, nor are settled nodes walked."""
    from tidemark.operators import unkeyed
    dealt, walked = [], []
    deal, walk = unkeyed.with_next_marked, unkeyed._reached
    monkeypatch.setattr(unkeyed, "with_next_marked", lambda df, *a: (dealt.append(df.count()), deal(df, *a))[1])
    monkeypatch.setattr(unkeyed, "_reached", lambda nodes, *a: (walked.append(nodes.count()), walk(nodes, *a))[1])
    events = [("c", None, {"x": 1, "y": "p"})] + [("u", {"x": 1}, {"x": 1})] * 3 + [("d", {"x": 100 + i, "y": "q"}, None) for i in range(40)]
    typed = typed_of(spark, events, BAG)
    assert collected(unkeyed_noop_events(None, typed)) == sorted([(i, "no_row") for i in range(4, 44)], key=repr)
    assert len(dealt) == 4 and max(dealt[1:]) < 20 and len(walked) == 1
    assert collected(apply_unkeyed(None, typed)) == [(1, "p")]


def test_rounds_of_many_and_of_few_rows_agree(spark, monkeypatch):
    """Joins change from shuffles to broadcasts between rounds."""
    from tidemark.operators import unkeyed
    from tidemark import session
    rng = random.Random(12)
    events = [("c", None, {"x": k, "y": rng.choice("pq")}) for k in range(6)]
    for _ in range(12):
        k = rng.randrange(3)
        events.append(rng.choice([("u", {"x": k}, {"x": k}), ("u", {"x": k, "y": "p"}, {"y": "q"}), ("u", {"y": "q"}, {"x": k}), ("d", {"x": k + 3, "y": "p"}, None)]))
    typed = typed_of(spark, events, BAG)
    want = collected(apply_unkeyed(None, typed)), collected(unkeyed_noop_events(None, typed))
    monkeypatch.setattr(unkeyed, "FEW_ROWS", 4)
    monkeypatch.setattr(unkeyed, "is_few", lambda df: session.is_few(df, 4))
    assert (collected(apply_unkeyed(None, typed)), collected(unkeyed_noop_events(None, typed))) == want
