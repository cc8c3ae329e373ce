"""Relational databases through Spark's JDBC source: partitioned snapshot reads and a set-based upsert sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.catalog import family


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower: int | str | None = None, upper: int | str | None = None, num_partitions: int = 64,
               fetch_size: int = 10_000, options: Mapping[str, str] | None = None) -> DataFrame:
    """Snapshot read of one table, split on `partition_column` into parallel range queries."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def _quote(name: str, database: str) -> str:
    mark = "`" if family(database) == "mysql" else '"'
    return f"{mark}{name}{mark}"


def merge_statement(database: str, table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """One statement that upserts a staging table into the target.

    PostgreSQL family: rows that carry only the key, or tables without one, leave conflicting rows alone.
    MySQL family: duplicates are overwritten with the staged values.
    """
    def q(name: str) -> str:
        return _quote(name, database)

    listed = ", ".join(map(q, columns))
    insert = f"INSERT INTO {q(table)} ({listed}) SELECT {listed} FROM {q(staging)}"
    if family(database) == "mysql":
        # "WHERE true" keeps the parser from reading ON as a join condition.
        sets = ", ".join(f"{q(c)} = VALUES({q(c)})" for c in columns)
        return f"{insert} WHERE true ON DUPLICATE KEY UPDATE {sets}"
    updated = [c for c in columns if c not in keys]
    target = f" ({', '.join(map(q, keys))})" if keys else ""
    if not keys or not updated:
        return f"{insert} ON CONFLICT{target} DO NOTHING"
    sets = ", ".join(f"{q(c)} = EXCLUDED.{q(c)}" for c in updated)
    return f"{insert} ON CONFLICT{target} DO UPDATE SET {sets}"


def delete_statement(database: str, table: str, staging: str, keys: Sequence[str]) -> str:
    """One statement that removes the target rows whose key is staged."""
    def q(name: str) -> str:
        return _quote(name, database)

    same = " AND ".join(f"s.{q(k)} = {q(table)}.{q(k)}" for k in keys)
    return f"DELETE FROM {q(table)} WHERE EXISTS (SELECT 1 FROM {q(staging)} s WHERE {same})"


def upsert_to_database(latest: DataFrame, url: str, database: str, table: str, keys: Sequence[str],
                       execute: Callable[[Sequence[str]], None], options: Mapping[str, str] | None = None,
                       batch_size: int = 10_000) -> None:
    """Write the last state per key (`latest_per_key`) to a relational table.

    Executors load two staging tables in parallel; then `execute` runs the delete and the upsert in one
    transaction on the target. One row per key reaches the database, however many events there were.
    """
    columns = [c for c in latest.columns if c != "deleted"]
    sides = {f"{table}__upserts": latest.where("NOT deleted").select(*columns),
             f"{table}__deletes": latest.where("deleted").select(*keys)}
    for name, rows in sides.items():
        writer = (rows.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", name)
                  .option("batchsize", batch_size))
        for key, value in (options or {}).items():
            writer = writer.option(key, value)
        writer.save()
    execute([delete_statement(database, table, f"{table}__deletes", keys),
             merge_statement(database, table, f"{table}__upserts", columns, keys)])
