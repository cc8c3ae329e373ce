"""Progress of a replication per table: counts, phase, snapshot share, status report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_counts(events: DataFrame, order_col: str = "seq", time_col: str | None = None) -> DataFrame:
    """Per table: snapshot rows, inserts, updates, deletes, last event, last phase, any streaming event.

    Counting ignores whether an event had an image to apply; unknown operations count as nothing. All
    aggregates combine on the map side. Also valid on a streaming DataFrame.
    """
    kind = F.col("counted_as")
    counted = kind.isNotNull()
    streamed = F.when(counted, (kind != "SNAPSHOT").cast("int"))  # a number keeps this a hash aggregate
    aggregates = [
        F.count_if(kind == "SNAPSHOT").alias("snapshot_rows"),
        F.count_if(kind == "INSERT").alias("inserts"),
        F.count_if(kind == "UPDATE").alias("updates"),
        F.count_if(kind == "DELETE").alias("deletes"),
        F.max_by(streamed, F.when(counted, F.col(order_col))).alias("last_streamed"),
        F.max(F.col("stage") == "stream").alias("streaming_seen"),
    ]
    if time_col:
        aggregates.append(F.max(F.when(counted, F.col(time_col))).alias("last_event"))
    return (events.groupBy("table").agg(*aggregates)
            .withColumn("last_phase", F.when(F.col("last_streamed") == 0, "SNAPSHOT").when(F.col("last_streamed") == 1, "CDC")).drop("last_streamed"))


_NUMBERS = ["snapshot_rows", "inserts", "updates", "deletes"]


def progress_state(events: DataFrame, order_col: str = "seq", time_col: str | None = None) -> DataFrame:
    """Per table what `event_counts` gives, in a form that merges: counts add up, the phase goes with the highest position."""
    kind = F.col("counted_as")
    counted = kind.isNotNull()
    position = F.when(counted, F.col(order_col))
    last = F.max(F.when(counted, F.col(time_col))) if time_col else F.lit(None).cast("timestamp")
    return events.groupBy("table").agg(
        *[F.count_if(kind == k).alias(c) for k, c in zip(("SNAPSHOT", "INSERT", "UPDATE", "DELETE"), _NUMBERS)],
        F.max(position).cast("bigint").alias("last_position"), F.max_by((kind != "SNAPSHOT").cast("int"), position).alias("last_streamed"),
        F.max((F.col("stage") == "stream").cast("int")).alias("streaming_seen"), last.cast("timestamp").alias("last_event"))


def merge_progress(*states: DataFrame) -> DataFrame:
    """One state from the states of parts of a log, in whatever order they come."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy("table").agg(
        *[F.sum(c).alias(c) for c in _NUMBERS], F.max("last_position").alias("last_position"),
        F.max_by("last_streamed", "last_position").alias("last_streamed"), F.max("streaming_seen").alias("streaming_seen"), F.max("last_event").alias("last_event"))


def progress_of(state: DataFrame, registered: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """As `progress`, from a state."""
    phase = F.when(F.col("last_streamed") == 0, "SNAPSHOT").when(F.col("last_streamed") == 1, "CDC")
    counts = state.withColumn("last_phase", phase).withColumn("streaming_seen", F.col("streaming_seen") == 1).drop("last_streamed", "last_position")
    return _finish(counts, registered, totals)


def progress(events: DataFrame, registered: DataFrame | None = None, totals: DataFrame | None = None,
             order_col: str = "seq", time_col: str | None = None) -> DataFrame:
    """One row per table: counts, changes, phase, and with `totals` (table, total) the snapshot share.

    `registered` lists tables that show up even without events; tables seen in the log are added. A table
    none of whose events counts is INITIALIZING until any streaming event was seen, then CDC.
    """
    return _finish(event_counts(events, order_col, time_col), registered, totals)


def _finish(counts: DataFrame, registered: DataFrame | None, totals: DataFrame | None) -> DataFrame:
    everywhere = Window.partitionBy(F.lit(1))  # over one row per table
    counts = counts.withColumn("streaming", F.max("streaming_seen").over(everywhere)).drop("streaming_seen")
    counted = F.col("last_phase").isNotNull()
    if registered is not None:
        counts = registered.select("table").distinct().withColumn("registered", F.lit(True)).join(counts, "table", "full_outer")
        counts = (counts.withColumn("streaming", F.max("streaming").over(everywhere))
                  .where(counted | F.col("registered")).drop("registered"))
    else:
        counts = counts.where(counted)
    numbers = ["snapshot_rows", "inserts", "updates", "deletes"]
    counts = counts.withColumns({c: F.coalesce(c, F.lit(0)) for c in numbers})
    phase = F.coalesce("last_phase", F.when(F.col("streaming"), "CDC").otherwise("INITIALIZING"))
    result = counts.withColumns({"phase": phase, "changes": F.col("inserts") + F.col("updates") + F.col("deletes")})
    if totals is not None:
        result = result.join(totals.select("table", "total"), "table", "left")
    else:
        result = result.withColumn("total", F.lit(None).cast("bigint"))
    result = result.withColumn("total", F.coalesce("total", F.lit(-1)))
    times = ["last_event"] if "last_event" in result.columns else []
    return result.select("table", "phase", *numbers, "changes", *times, "total",
                         snapshot_percent(F.col("snapshot_rows"), F.col("total")).alias("snapshot_pct"),
                         snapshot_label(F.col("snapshot_rows"), F.col("total")).alias("snapshot_label"))


def with_overall(per_table: DataFrame) -> DataFrame:
    """Changes per table and overall (table TOTAL)."""
    sums = ["inserts", "updates", "deletes", "changes"]
    return (per_table.rollup("table").agg(*[F.sum(c).alias(c) for c in sums], F.grouping("table").alias("is_total"))
            .select(F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("table")).alias("table"), *sums))


def snapshot_percent(scanned: Column, total: Column) -> Column:
    """-1 while the total is unknown."""
    return F.when(total > 0, scanned / total * 100.0).otherwise(-1.0)


def snapshot_label(scanned: Column, total: Column) -> Column:
    share = F.format_string("%.1f%% (%,d/%,d)", scanned / total * 100.0, scanned, total)
    return F.when(total > 0, share).otherwise(F.concat(scanned.cast("string"), F.lit(" rows")))


def elapsed_label(ms: Column) -> Column:
    def whole(unit: int) -> Column:
        return F.floor(ms / unit).cast("bigint").cast("string")
    return (F.when(ms < 1_000, F.concat(ms.cast("string"), F.lit("ms")))
            .when(ms < 60_000, F.concat(whole(1_000), F.lit("s ago")))
            .when(ms < 3_600_000, F.concat(whole(60_000), F.lit("m ago")))
            .otherwise(F.concat(whole(3_600_000), F.lit("h ago"))))


def status_report(per_table: DataFrame, now: Column) -> DataFrame:
    """Report lines sorted by table. `now` is a timestamp expression; the wall clock is never read here."""
    ms = F.timestamp_diff("MILLISECOND", F.col("last_event"), now)
    last = F.when(F.col("last_event").isNotNull(), elapsed_label(ms))
    return (per_table.select(
        "table", "phase",
        F.when(F.col("phase") == "INITIALIZING", "-").otherwise(F.col("snapshot_label")).alias("snapshot"),
        "inserts", "updates", "deletes", last.alias("last")).orderBy("table"))


def report_header(per_table: DataFrame) -> DataFrame:
    """(tables, total_changes): the first line of the report."""
    return per_table.agg(F.count("*").alias("tables"), F.sum("changes").alias("total_changes"))


def cleanup_trigger(events: DataFrame, order_col: str = "seq") -> DataFrame:
    """(position): where orphan cleanup starts, at the end of the snapshot or the first streaming event."""
    due = F.col("stage").isin("last", "stream")
    return events.agg(F.min(F.when(due, F.col(order_col))).alias("position"))
