"""The whole replay of a change log as one plan per table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import apply_changes, counted, rejected_events
from tidemark.operators.unkeyed import apply_unkeyed, rejected_unkeyed
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.changelog import decode_images, parse_events, split_events
from tidemark.sources.snapshot import events_for_mode


@dataclass(frozen=True)
class TableSpec:
    """What a replay needs to know about a table. Without keys the table is a bag of rows."""
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partial: bool = True
    units: Mapping[str, str] = field(default_factory=dict)
    time_columns: tuple[str, ...] = ()


def typed_table(events: DataFrame, name: str, spec: TableSpec) -> DataFrame:
    """Typed events of one table, filtered before any image is decoded."""
    return decode_images(events.where(F.col("table") == name), spec.schema, dict(spec.units), spec.time_columns,
                         spec.keys)


def apply_table(base: DataFrame | None, typed: DataFrame, spec: TableSpec, order_col: str = "seq") -> DataFrame:
    if spec.keys:
        return apply_changes(base, typed, spec.keys, order_col, spec.partial)
    return apply_unkeyed(base, typed, order_col)


def table_rejects(typed: DataFrame, spec: TableSpec, order_col: str = "seq") -> DataFrame:
    if spec.keys:
        return rejected_events(typed, spec.keys, order_col)
    return rejected_unkeyed(typed, spec.schema.names, order_col)


def counted_events(events: DataFrame, specs: Mapping[str, TableSpec], order_col: str = "seq") -> DataFrame:
    """Events that progress counts: those of unknown tables as they are, those of known ones as `counted` says."""
    kept = [c for c in events.columns if c not in ("before", "after", "before_schema", "after_schema")]
    parts = [events.where(~F.col("table").isin(list(specs))).select(*kept)]
    for name, spec in specs.items():
        typed = typed_table(events, name, spec)
        parts.append(typed.where(counted(typed, spec.keys)).select(*kept))
    return reduce(DataFrame.unionByName, parts)


def stage_events(events: DataFrame, path: str) -> DataFrame:
    """Write parsed events once, in one folder per table, and read them back.

    Rows are gathered by table first, so that there is not a file per task and table; adaptive execution
    splits a table that holds most of the log. Later filters on the table prune folders, and each table is read without parsing JSON again.
    """
    events.hint("rebalance", "table").write.mode("overwrite").partitionBy("table").parquet(path)
    return events.sparkSession.read.schema(events.schema).parquet(path)


def replicate(raw: DataFrame, specs: Mapping[str, TableSpec], bases: Mapping[str, DataFrame] | None = None,
              mode: str = "initial", order_col: str = "seq", staging: str | None = None,
              **parse_options) -> tuple[dict[str, DataFrame], DataFrame]:
    """Current tables by name, and all rejected events (order_col, table, op, reason).

    Every table is a plan of its own. The log of several tables is parsed once, into the `staging` folder (on
    storage all executors share) or, without one, into a new folder beside the checkpoints.
    """
    events = parse_events(raw, order_col, **parse_options)
    if not staging and len(specs) > 1:
        ensure_checkpoint_dir(raw.sparkSession)
        staging = f"{raw.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()}/staged-{uuid.uuid4().hex}"
    if staging:
        events = stage_events(events, staging)
    good, damaged = split_events(events, order_col, list(specs))
    good = events_for_mode(good, mode)
    tables, rejects = {}, [damaged.select(order_col, F.lit(None).cast("string").alias("table"),
                                          F.lit(None).cast("string").alias("op"), F.col("reject_reason").alias("reason"))]
    for name, spec in specs.items():
        typed = typed_table(good, name, spec)
        tables[name] = apply_table((bases or {}).get(name), typed, spec, order_col)
        rejects.append(table_rejects(typed, spec, order_col).select(order_col, F.lit(name).alias("table"), "op", "reason"))
    return tables, reduce(DataFrame.unionByName, rejects)
