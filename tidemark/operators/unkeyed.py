"""Changes to tables without a key: the table is a bag and rows are found by their before image.

One event after the other would mean: an insert adds a row; an update sets the columns its after image carries in every
row equal to the non-null before columns, or inserts the after image when there is none; a delete removes every such
row. The same result without a sequential pass:

* A row rests at one value from the event that put it there until the next later event whose before image matches that
  value, found by an equi-join in log order. So rows move along a forest whose edges point forward in the log. Its nodes
  are (event, value); those of the table as it was are its distinct rows.
* Only columns that some before image tests can decide where a row goes next, so the values of nodes hold these alone.
  An update that tests or writes all of them leaves one value behind. One that leaves some as they were (an open one) has
  a node per value that comes in; these are made round by round, as often as open updates follow one another in a row.
* All other columns are payload. What a row holds in them at the end is what the last update on its way wrote: every node
  carries what it writes, column by column, and pointer doubling puts these together along with the ways.
* An update that no row meets inserts one. Whether one came in is plain from the edges if the inserted row has the
  value that rows have after the update. Otherwise (a partial image) it depends on whether the updates before inserted
  theirs; rounds of reachability settle all those that depend on nothing open, the earliest always among them.
* Rows are counted at the roots of the forest, which pointer doubling finds in log2(longest way) rounds of joins.

Before images differ in which columns they test. This pattern is a part of the match key, so one join serves all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordered import DEFAULT_STRETCH, with_next_marked
from tidemark.session import FEW_ROWS, cut_lineage, is_few, joinable
from tidemark.sources.changelog import DELETE, readable

_CHUNK = 10_000
#: What an event does, as the last digit of its code: code = 8 * position + kind keeps the log order. An update is full
#: if its image carries all columns, closed if it tests or carries all columns that any event tests, else open.
ADD, FULL, CLOSED, OPEN, DROP = range(5)
#: The node of the row that a partial update inserts has the code of the event with this digit; searches start after the last.
_INSERTED, _AFTER = 5, 7
_NO, _MAYBE, _YES = 0, 1, 2


class Trace(NamedTuple):
    """nodes (id, successor, target, gone, values, writes, born), events by code, and the events that rows came to."""
    nodes: DataFrame
    updates: DataFrame
    drops: DataFrame
    hits: DataFrame
    untouched: DataFrame | None
    tested: list[str]
    payload: list[str]
    few: bool


def _any(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def _all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _usable(columns: Sequence[str]) -> Column:
    """Whether a before image can find rows: some column is not null."""
    return F.col("has_before") & _any([F.col(f"before.{c}").isNotNull() for c in columns])


def _bag_events(typed: DataFrame, columns: Sequence[str], order_col: str) -> DataFrame:
    """Applicable events as (position, action, row, was, tests, has); `tests` and `has` are booleans per column."""
    # An update or insert whose image carries no column does nothing.
    carries = _any([F.col(f"present.{c}") for c in columns])
    action = (F.when(F.col("action") == DELETE, F.when(_usable(columns), "drop"))
              .when((F.col("op") == "u") & _usable(columns), F.when(carries, "move"))
              .when(carries, "add"))
    tests = [(F.col("has_before") & F.col(f"before.{c}").isNotNull()).alias(c) for c in columns]
    return (typed.where(F.col("applies") & readable(typed))
            .select(F.col(order_col).alias("position"), action.alias("action"),
                    F.struct(*[F.when(F.col(f"present.{c}"), F.col(f"after.{c}")).alias(c) for c in columns]).alias("row"),
                    F.struct(*[F.col(f"before.{c}").alias(c) for c in columns]).alias("was"), F.struct(*tests).alias("tests"),
                    F.struct(*[F.coalesce(F.col(f"present.{c}"), F.lit(False)).alias(c) for c in columns]).alias("has"))
            .where(F.col("action").isNotNull()))


def rejected_unkeyed(typed: DataFrame, columns: Sequence[str], order_col: str = "seq") -> DataFrame:
    """Events that cannot be applied to a table without a key, with the reason."""
    reason = (F.when(~readable(typed), "unreadable_value")
              .when((F.col("action") == DELETE) & ~_usable(columns), "no_usable_before"))
    return (typed.where(F.col("applies")).select(order_col, "op", reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def _pick(struct: str, columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{struct}.{c}").alias(c) for c in columns]) if columns else F.struct(F.lit(None).cast("int").alias("_"))


def _writes(payload: Sequence[str], value: str, has: str | None = None) -> Column:
    """Per payload column a struct around what is written, or null where nothing is."""
    def one(c: str) -> Column:
        boxed = F.struct(F.col(f"{value}.{c}").alias("v"))
        return (F.when(F.col(f"{has}.{c}"), boxed) if has else boxed).alias(c)
    return F.struct(*[one(c) for c in payload]) if payload else F.struct(F.lit(None).cast("int").alias("_"))


def _later(first: str, then: str, payload: Sequence[str]) -> Column:
    """Writes of two stretches of a way, one after the other."""
    if not payload:
        return F.col(first)
    return F.struct(*[F.coalesce(F.col(f"{then}.{c}"), F.col(f"{first}.{c}")).alias(c) for c in payload])


def _successors(nodes: DataFrame, clearing: DataFrame, tested: Sequence[str], stretch: int,
                patterns: DataFrame | None = None, few: bool = False) -> DataFrame:
    """(id, successor): the first event after each node that matches its values.

    `patterns`: those of the events, if they were gathered before. `few`: the nodes are few, whatever the events are.
    """
    # A match key is the pattern and the tested values. All patterns of the log come as one array, from one aggregate.
    patterns = (clearing if patterns is None else patterns).agg(F.collect_set("pattern")).scalar()
    on = {c: F.substring("pattern", i + 1, 1) == "1" for i, c in enumerate(tested)}
    looked_up = (nodes.select("id", "after", "values", F.explode(patterns).alias("pattern"))
                 .where(_all([~on[c] | F.col(f"values.{c}").isNotNull() for c in tested]))
                 .select(F.col("after").alias("code"), F.col("id").alias("node"),
                         F.struct("pattern", *[F.when(on[c], F.col(f"values.{c}")).alias(c) for c in tested]).alias("match")))
    keys = clearing.select("code", F.lit(None).cast("bigint").alias("node"),
                           F.struct("pattern", *[F.when(on[c], F.col(f"was.{c}")).alias(c) for c in tested]).alias("match"))
    if few:
        # Events that no node looks up are not dealt out.
        keys = keys.join(F.broadcast(looked_up.select("match").distinct()), "match", "left_semi").select("code", "node", "match")
    return (with_next_marked(looked_up.unionByName(keys), "match", "code", F.col("node").isNull(), "successor", stretch)
            .where(F.col("node").isNotNull() & F.col("successor").isNotNull())
            .groupBy(F.col("node").alias("id")).agg(F.min("successor").alias("successor")))


def _kind(code: str) -> Column:
    return F.pmod(F.col(code), F.lit(8))


def _own_ids(rows: DataFrame, generation: int) -> DataFrame:
    """Negative ids, fixed by a checkpoint, that no event's code equals."""
    return cut_lineage(rows.withColumn("id", F.lit(-1 - (generation << 48)).cast("bigint") - F.monotonically_increasing_id()))


def _met(rows: DataFrame, opens: DataFrame, few: bool) -> DataFrame:
    """Rows (code, ...) with their open updates, which may be many even if the rows are few."""
    return opens.join(F.broadcast(rows), "code") if few else rows.join(opens.hint("merge"), "code")


def _grow(events: DataFrame, base: DataFrame | None, tested: list[str], payload: list[str], stretch: int, few: bool) -> tuple[DataFrame, DataFrame]:
    """All nodes with their targets, and the updates."""
    # Rounds read these again and again, so they hold no more than that.
    clearing = cut_lineage(events.where(F.col("kind") != ADD).select("code", "pattern", _pick("was", tested).alias("was")))
    patterns = cut_lineage(clearing.select("pattern").distinct())
    opens = cut_lineage(events.where(F.col("kind") == OPEN).select("code", "row", "was", "tests", "has"))
    after = (F.col("code") - F.col("kind") + _AFTER).alias("after")
    kept = [F.when(F.col(f"has.{c}"), F.col(f"row.{c}")).when(F.col(f"tests.{c}"), F.col(f"was.{c}")).alias(c) for c in tested]
    born = events.where(F.col("kind").isin(ADD, FULL)).select(
        F.col("code").alias("id"), after, _pick("row", tested).alias("values"), _writes(payload, "row").alias("writes"),
        F.when(F.col("kind") == ADD, 1).cast("bigint").alias("born"))
    partial = events.where(F.col("kind").isin(CLOSED, OPEN))
    inserted = partial.select((F.col("code") - F.col("kind") + _INSERTED).alias("id"), after, _pick("row", tested).alias("values"),
                              _writes(payload, "row").alias("writes"), F.lit(None).cast("bigint").alias("born"))
    closed = events.where(F.col("kind") == CLOSED).select(
        F.col("code").alias("id"), after, F.struct(*kept).alias("values"), _writes(payload, "row", "has").alias("writes"), F.lit(0).cast("bigint").alias("born"))
    fresh = born.unionByName(inserted).unionByName(closed)
    if base is not None:
        fresh = fresh.unionByName(base.select("id", F.lit(-1).cast("bigint").alias("after"), "values", "writes", "born"))
    fresh = cut_lineage(fresh)
    parts, generation, now_few = [], 0, few
    while True:
        placed = cut_lineage(fresh.join(joinable(_successors(fresh, clearing, tested, stretch, patterns, now_few), now_few), "id", "left"))
        entering = placed.where(_kind("successor") == OPEN).select("id", F.col("successor").alias("code"), F.col("values").alias("came"))
        target = F.when(_kind("successor").isin(FULL, CLOSED), F.col("successor"))
        generation += 1
        became = F.struct(*[F.when(F.col(f"has.{c}"), F.col(f"row.{c}")).when(F.col(f"tests.{c}"), F.col(f"was.{c}"))
                            .otherwise(F.col(f"came.{c}")).alias(c) for c in tested])
        moved = _met(entering, opens, now_few).select(F.col("id").alias("from"), "code", became.alias("values"))
        nodes = _own_ids(moved.select("code", "values").distinct(), generation)
        was_few, size = now_few, nodes.limit(FEW_ROWS + 1).count()
        if not size:
            parts.append(placed.withColumn("target", target))
            break
        into = moved.join(joinable(nodes, was_few), ["code", "values"]).select(F.col("from").alias("id"), F.col("id").alias("_into"))
        parts.append(placed.join(joinable(into, was_few), "id", "left").withColumn("target", F.coalesce("_into", target)).drop("_into"))
        now_few = size <= FEW_ROWS
        fresh = cut_lineage(_met(nodes, opens, now_few).select("id", (F.col("code") - OPEN + _AFTER).alias("after"), "values",
                                                               _writes(payload, "row", "has").alias("writes"), F.lit(0).cast("bigint").alias("born")))
    nodes = reduce(DataFrame.unionByName, parts).withColumn("gone", F.coalesce(_kind("successor") == DROP, F.lit(False)))
    if len(parts) > 1:
        nodes = cut_lineage(nodes.coalesce(max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    return nodes, events.where(F.col("kind").isin(FULL, CLOSED, OPEN)).select("code", "kind")


def _reached(nodes: DataFrame, seeds: DataFrame, few: bool) -> DataFrame:
    """(id, flag): the highest flag among the seeds (id, flag) whose ways lead through a node."""
    inner = nodes.where(F.col("target").isNotNull()).select(F.col("target").alias("id")).distinct()
    handed = seeds.join(joinable(nodes.select("id", "target"), few), "id").where(F.col("target").isNotNull()).groupBy(F.col("target").alias("id")).agg(F.max("flag").alias("handed"))
    state = (inner.join(joinable(nodes.select("id", F.col("target").alias("hop")), few), "id").join(joinable(seeds, few), "id", "left")
             .join(joinable(handed, few), "id", "left")
             .select("id", "hop", F.greatest(F.coalesce("flag", F.lit(_NO)), F.coalesce("handed", F.lit(_NO))).alias("flag")))
    state = cut_lineage(state)
    while state.where(F.col("hop").isNotNull()).limit(1).count():
        pushed = state.where(F.col("hop").isNotNull() & (F.col("flag") > _NO)).groupBy(F.col("hop").alias("id")).agg(F.max("flag").alias("pushed"))
        ahead = state.select(F.col("id").alias("hop"), F.col("hop").alias("_hop"))
        state = cut_lineage(state.join(joinable(pushed, few), "id", "left").join(joinable(ahead, few), "hop", "left").select(
            "id", F.col("_hop").alias("hop"), F.greatest("flag", F.coalesce("pushed", F.lit(_NO))).alias("flag")))
    return (seeds.select("id", "flag").unionByName(state.select("id", "flag")).groupBy("id").agg(F.max("flag").alias("flag"))
            .where(F.col("flag") > _NO))


def _settled(nodes: DataFrame, partial: bool, few: bool) -> tuple[DataFrame, DataFrame]:
    """(code) of the events that rows came to, and (id) of the inserted rows of partial updates that were inserted."""
    sure = nodes.where((F.col("id") < 0) & (F.col("born") > 0) | (F.col("id") >= 0) & _kind("id").isin(ADD, FULL))
    if not partial:
        return cut_lineage(nodes.where(F.col("successor").isNotNull()).select(F.col("successor").alias("code")).distinct()), nodes.where("false").select("id")
    # Rows that are sure to reach a node stay sure, as does all that lies ahead of it, so a round leaves these nodes out of
    # the next one, and with them the events they come to.
    waiting = cut_lineage(nodes.where((F.col("id") >= 0) & (_kind("id") == _INSERTED)).select("id", F.lit(_MAYBE).alias("flag")))
    seeds = sure.select("id", F.lit(_YES).alias("flag")).unionByName(waiting)
    left, sure_hits, inserted = nodes.select("id", "successor", "target"), [], []
    while True:
        flags = cut_lineage(left.join(joinable(_reached(left, seeds, few), few), "id"))
        hits = cut_lineage(flags.where(F.col("successor").isNotNull()).groupBy(F.col("successor").alias("code")).agg(F.max("flag").alias("hit")))
        sure_hits.append(hits.where(F.col("hit") == _YES).select("code"))
        if not waiting.limit(1).count():
            break
        event = F.col("id") - _INSERTED
        found = waiting.join(joinable(hits.select((F.col("code") - _kind("code")).alias("_event"), "hit"), few), event == F.col("_event"), "left")
        seeds = cut_lineage(found.where(F.col("hit").isNull() | (F.col("hit") == _MAYBE)).select(
            "id", F.when(F.col("hit").isNull(), _YES).otherwise(_MAYBE).alias("flag")))
        if not seeds.limit(1).count():
            break
        waiting = seeds.where(F.col("flag") == _MAYBE)
        inserted.append(seeds.where(F.col("flag") == _YES).select("id"))
        left = flags.where(F.col("flag") == _MAYBE).select("id", "successor", "target")
        few = few or is_few(left)
    return cut_lineage(reduce(DataFrame.unionByName, sure_hits).distinct()), reduce(DataFrame.unionByName, inserted, waiting.where("false").select("id"))


def _trace(base: DataFrame | None, typed: DataFrame, columns: Sequence[str], order_col: str, stretch: int) -> Trace | DataFrame:
    """The forest of a log; if no event looks for rows, just its inserted rows."""
    events = cut_lineage(_bag_events(typed, columns, order_col))
    whole = _all([F.col(f"has.{c}") for c in columns])
    looks = F.when(F.col("action") != "add", True)
    shape = events.agg(F.count(looks).alias("n"), F.count("*").alias("events"), F.max((F.col("action") == "move") & ~whole).alias("partial"),
                       *[F.max(F.when(looks, F.col(f"tests.{c}"))).alias(f"some_{i}") for i, c in enumerate(columns)],
                       *[F.min(F.when(looks, F.col(f"tests.{c}"))).alias(f"all_{i}") for i, c in enumerate(columns)]).first()
    if not shape["n"]:
        return events.select("row")
    tested = [c for i, c in enumerate(columns) if shape[f"some_{i}"]]
    always = [c for i, c in enumerate(columns) if shape[f"all_{i}"]]
    payload = [c for c in columns if c not in tested]
    closed = _all([F.col(f"has.{c}") | F.col(f"tests.{c}") for c in tested])
    kind = (F.when(F.col("action") == "add", ADD).when(F.col("action") == "drop", DROP)
            .when(whole, FULL).when(closed, CLOSED).otherwise(OPEN))
    pattern = F.concat(*[F.when(F.col(f"tests.{c}"), "1").otherwise("0") for c in tested])
    events = events.select((F.col("position") * 8 + kind).alias("code"), kind.alias("kind"), "row", "was", "tests", "has", pattern.alias("pattern"))

    untouched, classes, few = None, None, shape["events"] <= FEW_ROWS
    if base is not None:
        rows, met = base.select(*columns), base.select(*columns)
        if always:
            # The columns that every before image tests tell at once which base rows no event can match.
            keys = events.where(F.col("kind") != ADD).select(*[F.col(f"was.{c}").alias(f"_k{i}") for i, c in enumerate(always)]).distinct()
            same = _all([F.col(c) == F.col(f"_k{i}") for i, c in enumerate(always)])
            untouched, met = rows.join(joinable(keys, few), same, "left_anti"), rows.join(joinable(keys, few), same, "left_semi")
        counted = met.groupBy(*columns).agg(F.count("*").alias("born")).select(F.struct(*columns).alias("row"), "born")
        classes = _own_ids(counted.select("born", _pick("row", tested).alias("values"), _writes(payload, "row").alias("writes")), 0)
        few = few and shape["events"] + classes.count() <= FEW_ROWS
    nodes, updates = _grow(events, classes, tested, payload, stretch, few)
    hits, inserted = _settled(nodes, bool(shape["partial"]), few)
    # An update without visitors puts one row at its own node: that of its whole image, or of the row it inserts.
    alone = updates.where(F.col("kind") == FULL).join(joinable(hits, few), "code", "left_anti").select(F.col("code").alias("id")).unionByName(inserted)
    nodes = nodes.join(joinable(alone.withColumn("_alone", F.lit(1).cast("bigint")), few), "id", "left").withColumn(
        "born", F.coalesce("born", "_alone", F.lit(0).cast("bigint"))).drop("_alone")
    return Trace(nodes, updates, events.where(F.col("kind") == DROP).select("code"), hits, untouched, tested, payload, few)


def _resting(traced: Trace) -> DataFrame:
    """(values, writes, count) of the rows that are left, at the ends of their ways."""
    nodes, payload, few = traced.nodes, traced.payload, traced.few
    targets = nodes.where(F.col("target").isNotNull()).select(F.col("target").alias("id")).distinct()
    # A node nobody comes to hands its rows on at once, summed per target and writes; only the others need doubling.
    outer = nodes.join(joinable(targets, few), "id", "left_anti").where(F.col("born") > 0)
    at_rest = outer.where(F.col("successor").isNull()).select("values", "writes", F.col("born").alias("count"))
    handed = outer.where(F.col("target").isNotNull()).groupBy(F.col("target").alias("id"), F.col("writes").alias("brought")).agg(F.sum("born").alias("count"))
    inner = cut_lineage(nodes.join(joinable(targets, few), "id", "left_semi").select("id", "target", "gone", "values", "writes", "born"))
    nothing = F.lit(None).cast(inner.schema["writes"].dataType)
    handed = handed.unionByName(inner.where(F.col("born") > 0).select("id", nothing.alias("brought"), F.col("born").alias("count")))
    state = inner.select("id", F.col("id").alias("root"), F.col("target").alias("hop"), "gone", "writes")
    while state.where(F.col("hop").isNotNull()).limit(1).count():
        ahead = state.select(F.col("id").alias("hop"), F.col("root").alias("_root"), F.col("hop").alias("_hop"),
                             F.col("gone").alias("_gone"), F.col("writes").alias("_writes"))
        jumped = (state.where(F.col("hop").isNotNull()).join(joinable(ahead, few), "hop")
                  .select("id", F.col("_root").alias("root"), F.col("_hop").alias("hop"), F.col("_gone").alias("gone"),
                          _later("writes", "_writes", payload).alias("writes")))
        state = cut_lineage(state.where(F.col("hop").isNull()).unionByName(jumped))
    ended = (handed.join(joinable(state.where(~F.col("gone")), few), "id").select("root", _later("brought", "writes", payload).alias("writes"), "count")
             .groupBy("root", "writes").agg(F.sum("count").alias("count"))
             .join(joinable(inner.select(F.col("id").alias("root"), "values"), few), "root"))
    return at_rest.unionByName(ended.select("values", "writes", "count"))


def _repeat_rows(counted: DataFrame, columns: Sequence[str], chunk: int = _CHUNK) -> DataFrame:
    """Each row `count` times; large counts are spread over tasks before they are written out."""
    out = [F.col(f"row.{c}").alias(c) for c in columns]
    few = (counted.where((F.col("count") > 0) & (F.col("count") <= chunk))
           .select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count")))))
    spark = counted.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("count") - 1, F.lit(chunk)))
    many = (counted.where(F.col("count") > chunk).select("row", "count", F.explode(blocks).alias("block"))
            .repartition(parts)
            .select("row", F.explode(F.sequence(F.col("block") * chunk + 1,
                                                F.least(F.col("count"), (F.col("block") + 1) * chunk)))))
    return few.select(*out).unionByName(many.select(*out))


def apply_unkeyed(base: DataFrame | None, typed: DataFrame, order_col: str = "seq",
                  stretch: int = DEFAULT_STRETCH) -> DataFrame:
    """Current bag of rows from a base table and typed changes; positions are integers >= 0.

    Columns that an inserted image leaves out are null; an update leaves them as they are.
    """
    columns = base.columns if base is not None else typed.schema["after"].dataType.names
    traced = _trace(base, typed, columns, order_col, stretch)
    if isinstance(traced, DataFrame):
        added = traced.select(*[F.col(f"row.{c}").alias(c) for c in columns])
        return added if base is None else base.select(*columns).unionByName(added)
    held = {c: F.col(f"values.{c}") for c in traced.tested} | {c: F.col(f"writes.{c}.v") for c in traced.payload}
    result = _repeat_rows(_resting(traced).select(F.struct(*[held[c].alias(c) for c in columns]).alias("row"), "count"), columns)
    return result if traced.untouched is None else traced.untouched.unionByName(result)


def unkeyed_noop_events(base: DataFrame | None, typed: DataFrame, order_col: str = "seq",
                        stretch: int = DEFAULT_STRETCH) -> DataFrame:
    """(order_col, reason): deletes that met no row, and updates that inserted because they met none."""
    columns = base.columns if base is not None else typed.schema["after"].dataType.names
    traced = _trace(base, typed, columns, order_col, stretch)
    if isinstance(traced, DataFrame):
        return typed.sparkSession.createDataFrame([], f"{order_col} bigint, reason string")
    position = F.floor(F.col("code") / 8).cast("bigint").alias(order_col)
    missed = traced.drops.join(joinable(traced.hits, traced.few), "code", "left_anti").select(position, F.lit("no_row").alias("reason"))
    fell_back = traced.updates.join(joinable(traced.hits, traced.few), "code", "left_anti").select(position, F.lit("update_inserted").alias("reason"))
    return missed.unionByName(fell_back)
