"""Replicated keyed tables as Parquet folders by key bucket; a batch rewrites the folders it changes and no other.

What is stored per key is a state that merges in any order: values with the positions of the events that wrote them, and
the positions of the last upsert and delete. Of two values of a column the one with the higher position counts, so an
event that comes late, twice, or in the wrong batch never wins over a newer one, and batches in any order give what the
whole log gives. A deleted key stays as a tombstone until `horizon` positions have passed.

Rewriting is Spark's dynamic partition overwrite on the bucket column. Its commit moves bucket after bucket: a reader
may meet a batch in some buckets only, and after a lost driver the batch is applied again, which changes nothing where
it was already there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import latest_per_key, partial_state
from tidemark.operators.reconcile import key_pairs
from tidemark.session import cut_lineage

BUCKET, UPSERTED, REMOVED = "_bucket", "_upserted", "_removed"
#: Position of rows that were there before the log.
BEFORE = -1


def written_at(column: str) -> str:
    """Name of the position of a column's value."""
    return f"_at_{column}"


def state_columns(columns: Sequence[str], keys: Sequence[str], partial: bool) -> list[str]:
    """Columns of a state. With complete images all columns of a key are as old as its last upsert."""
    others = [c for c in columns if c not in keys]
    return [*columns, *[written_at(c) for c in others if partial], UPSERTED, REMOVED]


def is_alive() -> Column:
    return F.col(UPSERTED).isNotNull() & (F.col(REMOVED).isNull() | (F.col(UPSERTED) > F.col(REMOVED)))


def changes_state(typed: DataFrame, columns: Sequence[str], keys: Sequence[str], partial: bool, order_col: str = "seq") -> DataFrame:
    """One row per changed key of a batch of typed events, as a state."""
    others = [c for c in columns if c not in keys]
    if partial:
        state = partial_state(typed, keys, others, order_col)
        return state.select(*keys, *[F.col(f"_s_{c}.v").alias(c) for c in others], *[F.col(f"_s_{c}.at").alias(written_at(c)) for c in others],
                            UPSERTED, REMOVED).select(*state_columns(columns, keys, True))
    last = latest_per_key(typed, keys, columns, order_col, position="_at")
    return last.select(*columns, F.when(~F.col("deleted"), F.col("_at")).alias(UPSERTED), F.when(F.col("deleted"), F.col("_at")).alias(REMOVED))


def _newer(mine: str, other: str) -> Column:
    return F.col(mine).isNotNull() & (F.col(other).isNull() | (F.col(mine) > F.col(other)))


def _last(struct: str) -> Column:
    return F.greatest(f"{struct}.{UPSERTED}", f"{struct}.{REMOVED}")


def merge_states(old: DataFrame, new: DataFrame, columns: Sequence[str], keys: Sequence[str], partial: bool) -> DataFrame:
    """(old keys, state, changed) of the keys of `new`: both states merged, and whether that differs from the old one."""
    names = state_columns(columns, keys, partial)
    others = [c for c in columns if c not in keys]
    packed = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*[c for c in names if c not in keys]).alias("_o"))
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_k{i}"))
    both = new.select(*keys, F.struct(*[c for c in names if c not in keys]).alias("_n")).join(packed, match, "left")
    high = {c: F.greatest(f"_n.{c}", f"_o.{c}") for c in (UPSERTED, REMOVED)}
    if partial:
        fresh = {c: _newer(f"_n.{written_at(c)}", f"_o.{written_at(c)}") for c in others}
        # What is older than the last delete has no effect any more.
        matters = F.col(f"_o.{REMOVED}").isNull() | (F.col(f"_n.{UPSERTED}") > F.col(f"_o.{REMOVED}"))
        changed = F.col("_o").isNull() | (_newer(f"_n.{UPSERTED}", f"_o.{UPSERTED}") & matters) | _newer(f"_n.{REMOVED}", f"_o.{REMOVED}")
        for c in others:
            changed = changed | (fresh[c] & matters)
        positions = [F.greatest(f"_n.{written_at(c)}", f"_o.{written_at(c)}").alias(written_at(c)) for c in others]
    else:
        # A batch names the last event of a key only; an older one of the other kind no longer matters. At one position
        # a delete wins: that is how orphans go.
        tie = (_last("_n") == _last("_o")) & F.col(f"_n.{UPSERTED}").isNull() & F.col(f"_o.{UPSERTED}").isNotNull()
        changed = F.col("_o").isNull() | (_last("_n") > _last("_o")) | tie
        fresh, positions = dict.fromkeys(others, changed), []
        high = {c: F.when(changed, F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")) for c in high}
    values = [F.when(fresh[c], F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c) for c in others]
    merged = both.select(*keys, *values, *positions, *[h.alias(c) for c, h in high.items()], changed.alias("_changed"))
    return merged.select(*names, "_changed")


def alive_rows(state: DataFrame, columns: Sequence[str], keys: Sequence[str], partial: bool) -> DataFrame:
    """The table that a state stands for."""
    def value(c: str) -> Column:
        if not partial or c in keys:
            return F.col(c)
        return F.when(F.col(REMOVED).isNull() | (F.col(written_at(c)) > F.col(REMOVED)), F.col(c)).alias(c)
    return state.where(is_alive()).select(*[value(c) for c in columns])


class BucketStore:
    """A keyed table below `path`. The number of buckets is fixed when the first row is written."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], partial: bool = True,
                 buckets: int = 64, horizon: int | None = None):
        self.spark, self.path, self.keys, self.partial = spark, path.rstrip("/"), list(keys), partial
        self.columns, self.buckets, self.horizon = schema.names, buckets, horizon
        self._names = state_columns(self.columns, self.keys, partial)
        types = {f.name: f.dataType for f in schema.fields}
        self.schema = T.StructType([T.StructField(c, types.get(c, T.LongType())) for c in self._names] + [T.StructField(BUCKET, T.IntegerType())])

    def _folder(self) -> tuple[str, bool]:
        """Folder of the buckets, whose name tells how many there are; whether it is there."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        found = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        found = [name for name in found if name.startswith("of-")]
        if found and found != [f"of-{self.buckets}"]:
            raise ValueError(f"{self.path} has its rows in buckets {found}, not of-{self.buckets}")
        return f"{self.path}/of-{self.buckets}", bool(found)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def state(self) -> DataFrame:
        """All keys with their positions, tombstones included."""
        folder, there = self._folder()
        return self.spark.read.schema(self.schema).parquet(folder) if there else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return alive_rows(self.state(), self.columns, self.keys, self.partial)

    def _write(self, state: DataFrame) -> None:
        (state.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self._folder()[0]))

    def load(self, rows: DataFrame) -> None:
        """Rows that were there before the log; any event of their keys wins over them."""
        before = F.lit(BEFORE).cast("bigint")
        types = {f.name: f.dataType for f in self.schema.fields}
        positions = [before.alias(c) for c in self._names if c not in self.columns and c != REMOVED]
        self._write(rows.select(*[F.col(c).cast(types[c]).alias(c) for c in self.columns], *positions, F.lit(None).cast("bigint").alias(REMOVED)).select(*self._names))

    def changes(self, typed: DataFrame, order_col: str = "seq") -> DataFrame:
        return changes_state(typed, self.columns, self.keys, self.partial, order_col)

    def apply(self, changes: DataFrame) -> list[int]:
        """Merge changes (one row per key, see `changes`); returns the buckets that were written anew.

        Old rows are read from the buckets of the changed keys, and only buckets where a key really changes are
        written. So a batch that brings nothing new writes nothing.
        """
        changes = cut_lineage(changes.where(" AND ".join(f"`{k}` IS NOT NULL" for k in self.keys)).withColumn(BUCKET, self._bucket()))
        old = self.state()
        # At most one number per bucket.
        near = [r[0] for r in changes.select(BUCKET).distinct().collect()]
        merged = cut_lineage(merge_states(old.where(F.col(BUCKET).isin(near)), changes.drop(BUCKET), self.columns, self.keys, self.partial)
                             .where("_changed").drop("_changed").withColumn(BUCKET, self._bucket()))
        touched = sorted(r[0] for r in merged.select(BUCKET).distinct().collect())
        if not touched:
            return []
        same = F.lit(True)
        for k in self.keys:
            same = same & (F.col(k) == F.col(f"_m_{k}"))
        kept = old.where(F.col(BUCKET).isin(touched)).join(merged.select(*[F.col(k).alias(f"_m_{k}") for k in self.keys]), same, "left_anti")
        now = kept.select(*self._names).unionByName(merged.select(*self._names))
        if self.horizon is not None:
            highest = merged.agg(F.max(F.greatest(UPSERTED, REMOVED))).first()[0]
            now = now.where(is_alive() | (F.col(REMOVED) > highest - self.horizon))
        self._write(now)
        return touched

    def remove_orphans(self, source: DataFrame) -> int:
        """Delete rows whose key the source lacks, as of their last change; returns their number."""
        left, right = key_pairs(self.state().where(is_alive()), source, self.keys)
        orphans = left.join(right, right.columns, "left_anti")
        gone = cut_lineage(orphans.select(*self._names).withColumn(REMOVED, F.col(UPSERTED)))
        number = gone.count()
        if number:
            self.apply(gone.select(*self._names) if self.partial else gone.select(*self.columns, F.lit(None).cast("bigint").alias(UPSERTED), REMOVED))
        return number


# --- the same for catalogs with MERGE ------------------------------------------------------------------------

def guarded_merge_statement(target: str, source_view: str, columns: Sequence[str], keys: Sequence[str], partial: bool) -> str:
    """MERGE of a state into a catalog table that has the columns of `state_columns`; older positions never win.

    Deleted keys stay as tombstones; `purge_statement` removes those that are old enough, `alive_query` hides them.
    """
    others = [c for c in columns if c not in keys]
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    last = "greatest({0}.`" + UPSERTED + "`, {0}.`" + REMOVED + "`)"
    if partial:
        def newer(c: str) -> str:
            return f"s.`{c}` > coalesce(t.`{c}`, {BEFORE - 1})"
        when = " OR ".join(newer(c) for c in [*map(written_at, others), UPSERTED, REMOVED])
        sets = [f"t.`{c}` = CASE WHEN {newer(written_at(c))} THEN s.`{c}` ELSE t.`{c}` END" for c in others]
        sets += [f"t.`{c}` = greatest(t.`{c}`, s.`{c}`)" for c in [*map(written_at, others), UPSERTED, REMOVED]]
    else:
        when = f"{last.format('s')} > {last.format('t')}"
        sets = [f"t.`{c}` = s.`{c}`" for c in [*others, UPSERTED, REMOVED]]
    names = state_columns(columns, keys, partial)
    listed, values = ", ".join(f"`{c}`" for c in names), ", ".join(f"s.`{c}`" for c in names)
    return (f"MERGE INTO {target} t USING {source_view} s ON {on} WHEN MATCHED AND ({when}) THEN UPDATE SET {', '.join(sets)} "
            f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values})")


def purge_statement(target: str, before: int) -> str:
    """Remove tombstones of deletes before a position."""
    return f"DELETE FROM {target} WHERE `{REMOVED}` < {before} AND (`{UPSERTED}` IS NULL OR `{UPSERTED}` <= `{REMOVED}`)"


def alive_query(target: str, columns: Sequence[str], keys: Sequence[str], partial: bool) -> str:
    """What a view over such a table shows."""
    def value(c: str) -> str:
        if not partial or c in keys:
            return f"`{c}`"
        return f"CASE WHEN `{REMOVED}` IS NULL OR `{written_at(c)}` > `{REMOVED}` THEN `{c}` END AS `{c}`"
    return (f"SELECT {', '.join(map(value, columns))} FROM {target} "
            f"WHERE `{UPSERTED}` IS NOT NULL AND (`{REMOVED}` IS NULL OR `{UPSERTED}` > `{REMOVED}`)")


def merge_guarded(typed: DataFrame, target: str, columns: Sequence[str], keys: Sequence[str], partial: bool, order_col: str = "seq") -> None:
    """Apply typed changes to a catalog table that supports MERGE and holds a state."""
    view = "_tidemark_guarded_" + "".join(c if c.isalnum() else "_" for c in target)
    changes_state(typed, columns, keys, partial, order_col).createOrReplaceTempView(view)
    typed.sparkSession.sql(guarded_merge_statement(target, f"`{view}`", columns, keys, partial))
