"""Replicated tables: MERGE where the catalog supports it, versioned Parquet folders elsewhere.

A MERGE rewrites only what a batch touches, so large tables belong in such a catalog; a folder version
is a rewrite of the whole table.

A version is a folder `v-<number>-<tag>` that Spark's committer marks as complete. Readers take the
highest complete version, so a lost driver leaves at most an unmarked folder, which the next attempt
overwrites. The tag names the batch a version came from, which makes a repeated batch visible.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import latest_per_key, partial_state

_NAME = re.compile(r"^v-(\d{12})-(.+)$")


class Version(NamedTuple):
    number: int
    tag: str
    path: str


class TableStore:
    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), max(keep, 2)

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), root, jvm

    def versions(self) -> list[Version]:
        """Complete versions, oldest first."""
        fs, root, jvm = self._fs()
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            match = _NAME.match(name)
            if match and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(Version(int(match[1]), match[2], f"{self.path}/{name}"))
        return sorted(found)

    def read(self) -> DataFrame | None:
        known = self.versions()
        return self.spark.read.parquet(known[-1].path) if known else None

    def has(self, tag: str) -> bool:
        return any(v.tag == tag for v in self.versions())

    def write(self, table: DataFrame, tag: str) -> Version:
        """Write the next version; afterwards only the newest `keep` stay."""
        known = self.versions()
        number = known[-1].number + 1 if known else 0
        path = f"{self.path}/v-{number:012d}-{tag}"
        table.write.mode("overwrite").parquet(path)
        fs, _, jvm = self._fs()
        for old in known[: max(len(known) + 1 - self.keep, 0)]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(old.path), True)
        return Version(number, tag, path)


def merge_into_statement(target: str, source_view: str, columns: Sequence[str], keys: Sequence[str],
                         deleted: str = "deleted") -> str:
    """MERGE for catalogs whose tables support it; the source is `latest_per_key` as a view."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    others = [c for c in columns if c not in keys]
    listed = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.`{c}` = s.`{c}`' for c in others)} " if others else ""
    return (f"MERGE INTO {target} t USING {source_view} s ON {on} WHEN MATCHED AND s.`{deleted}` THEN DELETE "
            f"{update}WHEN NOT MATCHED AND NOT s.`{deleted}` THEN INSERT ({listed}) VALUES ({values})")


def merge_partial_statement(target: str, source_view: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """MERGE for images that leave columns out; the source is `partial_rows` as a view.

    A row that was deleted and created again within the batch keeps none of its old values.
    """
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    others = [c for c in columns if c not in keys]
    listed, values = ", ".join(f"`{c}`" for c in columns), ", ".join(f"s.`{c}`" for c in columns)
    sets = ", ".join(f"t.`{c}` = CASE WHEN s.`_has_{c}` THEN s.`{c}` WHEN s.`_removed` THEN NULL ELSE t.`{c}` END" for c in others)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if others else ""
    return (f"MERGE INTO {target} t USING {source_view} s ON {on} WHEN MATCHED AND NOT s.`_alive` THEN DELETE "
            f"{update}WHEN NOT MATCHED AND s.`_alive` THEN INSERT ({listed}) VALUES ({values})")


def partial_rows(typed: DataFrame, keys: Sequence[str], columns: Sequence[str], order_col: str = "seq") -> DataFrame:
    """One row per changed key: columns, which of them changed, whether the row lives, whether it was removed on the way."""
    others = [c for c in columns if c not in keys]
    removed, upserted = F.col("_removed"), F.col("_upserted")
    holds = {c: F.col(f"_s_{c}").isNotNull() & (removed.isNull() | (F.col(f"_s_{c}.at") > removed)) for c in others}
    return partial_state(typed, keys, others, order_col).select(
        *keys, *[F.when(holds[c], F.col(f"_s_{c}.v")).alias(c) for c in others], *[holds[c].alias(f"_has_{c}") for c in others],
        (upserted.isNotNull() & (removed.isNull() | (upserted > removed))).alias("_alive"), removed.isNotNull().alias("_removed"))


def merge_into_catalog(typed: DataFrame, target: str, keys: Sequence[str], order_col: str = "seq", partial: bool = False) -> None:
    """Apply typed changes to a catalog table that supports MERGE (Delta, Iceberg, ...); only touched rows are written.

    Applying a batch twice gives the same table.
    """
    columns = typed.schema["after"].dataType.names
    view = "_tidemark_" + re.sub(r"\W", "_", target)
    if partial:
        partial_rows(typed, keys, columns, order_col).createOrReplaceTempView(view)
        typed.sparkSession.sql(merge_partial_statement(target, f"`{view}`", columns, keys))
        return
    latest_per_key(typed, keys, columns, order_col).createOrReplaceTempView(view)
    typed.sparkSession.sql(merge_into_statement(target, f"`{view}`", columns, keys))
