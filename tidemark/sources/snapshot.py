"""Snapshot scan and snapshot modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Snapshot modes; the last one is forced for sources that cannot stream.
MODES = ("initial", "never", "schema_only", "always", "initial_only")
SNAPSHOT_ONLY_SOURCES = ("kingbase",)


def effective_mode(source_type: str, mode: str = "initial") -> str:
    if source_type in SNAPSHOT_ONLY_SOURCES:
        return "initial_only"
    if mode not in MODES:
        raise ValueError(f"unknown snapshot mode {mode!r}: use one of {', '.join(MODES)}")
    return mode


def snapshot_scan(table: DataFrame, name: str, position: Column | int = -1, order_col: str = "seq") -> DataFrame:
    """Rows of a source table as typed `r` events, ready for `apply_changes` on a keyed table.

    The columns are those of `decode_images`; nothing goes through JSON, and columns nobody asks for are
    pruned down to the scan.
    """
    row = F.struct(*[F.col(c) for c in table.columns])
    flags = {v: F.struct(*[F.lit(v).alias(c) for c in table.columns]) for v in (True, False)}
    return table.select(
        (F.lit(position) if isinstance(position, int) else position).cast("bigint").alias(order_col),
        F.lit(name).alias("table"), F.lit("r").alias("op"), F.lit("true").alias("snapshot"),
        F.lit("snapshot").alias("stage"), F.lit("upsert").alias("action"), F.lit("SNAPSHOT").alias("counted_as"),
        F.lit(True).alias("applies"), F.lit(None).cast(table.schema).alias("before"), row.alias("after"),
        flags[True].alias("present"), F.lit(False).alias("has_before"),
        flags[False].alias("unread_before"), flags[False].alias("unread_after"))


def events_for_mode(events: DataFrame, mode: str) -> DataFrame:
    """The part of a log that a snapshot mode lets through."""
    if mode in ("initial", "always"):
        return events
    if mode in ("never", "schema_only"):
        return events.where(F.col("op") != "r")
    if mode == "initial_only":
        return events.where(F.col("op") == "r")
    raise ValueError(f"unknown snapshot mode {mode!r}: use one of {', '.join(MODES)}")


def base_for_mode(spark: SparkSession, mode: str, schema: T.StructType, snapshot: DataFrame | None = None,
                  target: DataFrame | None = None) -> DataFrame | None:
    """The table a replay starts from: the snapshot, what the target holds, or an empty table."""
    if mode == "schema_only":
        return spark.createDataFrame([], schema)
    if mode == "never":
        return target
    if mode in ("initial", "always", "initial_only"):
        return snapshot if snapshot is not None else target
    raise ValueError(f"unknown snapshot mode {mode!r}: use one of {', '.join(MODES)}")


def after_position(events: DataFrame, position: int, order_col: str = "seq") -> DataFrame:
    """Resume a batch replay behind the last applied position."""
    return events.where(F.col(order_col) > position)
