"""Preflight checks over table lists, as rows (id, status, message, details)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_tables(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required tables (column `table`, optional `position`) that the catalog lacks.

    The catalog is read through the table selection, which takes exact names; among what it finds,
    names are compared in lower case.
    """
    known = _selected(required, present).select(F.lower("table").alias("_name")).distinct()
    return (required.withColumn("_name", F.lower("table")).join(known, "_name", "left_anti")
            .select(*required.columns))


def _selected(required: DataFrame, present: DataFrame) -> DataFrame:
    return present.join(required.select("table").distinct(), "table", "left_semi")


def _presence(required: DataFrame, present: DataFrame) -> DataFrame:
    """One row: how many tables are required and found, and the missing and found ones in list order.

    Both lists hold table names only, at most one entry per required table.
    """
    known = _selected(required, present).groupBy(F.lower("table").alias("_name")).agg(
        F.min("table").alias("_found"), F.count("column").alias("_columns"))
    position = F.col("position") if "position" in required.columns else F.col("table")
    joined = required.select("table", position.alias("_at"), F.lower("table").alias("_name")).join(known, "_name", "left")
    lost = F.col("_found").isNull()

    def listed(value: Column, wanted: Column) -> Column:
        pairs = F.array_sort(F.collect_list(F.when(wanted, F.struct(F.col("_at").alias("at"), value.alias("v")))))
        return F.transform(pairs, lambda p: p["v"])

    return joined.agg(
        F.count("*").alias("required"), F.count_if(~lost).alias("found"),
        listed(F.col("table"), lost).alias("missing"),
        listed(F.format_string("%s (%d columns)", "_found", "_columns"), ~lost).alias("present"))


# Fixed values below: the identifiers, statuses and message texts of a check are part of its result.
def table_checks(required: DataFrame, source: DataFrame, target: DataFrame, schema_sync: bool = True,
                 source_up: bool = True, target_up: bool = True) -> DataFrame:
    """Presence of the required tables in two column catalogs (rows of `catalog_of`).

    Missing in the source fails; missing in the target warns while schema sync creates tables, else fails.
    With an empty list everything passes.
    """
    lost = F.size("missing") > 0
    in_source = _presence(required, source).select(
        "required", F.lit("tables.source").alias("id"),
        F.when(lost, "FAIL").otherwise("PASS").alias("status"),
        F.when(lost, F.concat(F.lit("Missing in source: ["), F.array_join("missing", ", "), F.lit("]")))
        .otherwise(F.format_string("All %d configured table(s) found in source", "found")).alias("message"),
        F.when(lost, F.transform("missing", lambda t: F.concat(F.lit("not found: "), t)))
        .otherwise(F.col("present")).alias("details"))
    note = " (will be created by schema sync)" if schema_sync else " — schema sync is OFF"
    in_target = _presence(required, target).select(
        "required", F.lit("tables.target").alias("id"),
        F.when(lost, "WARN" if schema_sync else "FAIL").otherwise("PASS").alias("status"),
        F.when(lost, F.concat(F.size("missing").cast("string"), F.lit(" table(s) missing in target" + note)))
        .otherwise(F.format_string("All %d configured table(s) already exist in target", "found")).alias("message"),
        F.when(lost, F.transform("missing", lambda t: F.concat(F.lit("not in target: "), t)))
        .otherwise(F.array().cast("array<string>")).alias("details"))
    sides = []
    for name, up, rows in (("source", source_up, in_source), ("target", target_up, in_target)):
        if not up:
            rows = rows.select(
                "required", "id", F.lit("WARN").alias("status"),
                F.lit(f"{name.capitalize()} table check skipped (connection unavailable)").alias("message"),
                F.array().cast("array<string>").alias("details"))
        sides.append(rows.where(F.col("required") > 0))
    unlisted = (required.agg(F.count("*").alias("required")).where(F.col("required") == 0).select(
        "required", F.lit("tables").alias("id"), F.lit("PASS").alias("status"),
        F.lit("No specific tables configured — all source tables will be synced").alias("message"),
        F.array().cast("array<string>").alias("details")))
    return sides[0].unionByName(sides[1]).unionByName(unlisted).drop("required")


def check_summary(checks: DataFrame) -> DataFrame:
    """(total, passed, warned, failed, exit_code): the code is 1 as soon as one check fails."""
    failed = F.count_if(F.col("status") == "FAIL")
    warned = F.count_if(F.col("status") == "WARN")
    return checks.agg(F.count("*").alias("total"), (F.count("*") - failed - warned).alias("passed"),
                      warned.alias("warned"), failed.alias("failed"),
                      F.when(failed > 0, 1).otherwise(0).alias("exit_code"))
