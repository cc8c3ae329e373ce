"""Source against target: orphan rows, row counts, recent rows, growth rate and lag trend."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import normal_key_type


def key_pairs(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with added key columns `_k0`, `_k1`, ... cast to a common type; the source keeps only these."""
    types = [normal_key_type(target.schema[k].dataType, source.schema[k].dataType) for k in keys]
    named = {f"_k{i}": (k, t) for i, (k, t) in enumerate(zip(keys, types))}
    return (target.withColumns({n: F.col(k).cast(t) for n, (k, t) in named.items()}),
            source.select(*[F.col(k).cast(t).alias(n) for n, (k, t) in named.items()]))


def orphan_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose whole key is not in the source."""
    left, right = key_pairs(target, source, keys)
    return left.join(right, right.columns, "left_anti").select(*target.columns)


def _key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a complete key; -1 where a part is null."""
    null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return F.when(null, -1).otherwise(F.pmod(F.xxhash64(*keys), F.lit(buckets))).cast("int")


def differing_buckets(left: DataFrame, right: DataFrame, n_keys: int, buckets: int) -> DataFrame:
    """(_bucket) where the keys `_k0`, ... of both sides differ, as told by their number and two sums of 64-bit hashes."""
    keys = [f"_k{i}" for i in range(n_keys)]

    def digest(side: DataFrame, name: str) -> DataFrame:
        sums = [F.sum(F.xxhash64(*keys, F.lit(salt)).cast("decimal(38,0)")) for salt in (1, 2)]
        return (side.select(*keys).withColumn("_bucket", _key_bucket(keys, buckets)).where("_bucket >= 0").groupBy("_bucket")
                .agg(F.struct(F.count(F.lit(1)).alias("n"), sums[0].alias("a"), sums[1].alias("b")).alias(name)))

    both = digest(left, "_left").join(digest(right, "_right"), "_bucket", "left")
    return both.where(~F.col("_left").eqNullSafe(F.col("_right"))).select("_bucket")


def orphan_rows_pruned(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """As `orphan_rows`, for sides that are mostly equal: only buckets of keys that differ are joined.

    Both sides are read twice, but the first pass moves a number and two sums per bucket and task, and the second only
    the rows of buckets that differ. Equal digests say that both sides hold the same keys as often, unless both sums of
    hashes agree by chance (about 1 in 2^128 for keys that are not made to). Rows with a null in their key are orphans.
    """
    left, right = key_pairs(target, source, keys)
    named = right.columns
    # At most one row per bucket, whatever the size of the tables.
    differing = F.broadcast(differing_buckets(left, right, len(named), buckets))
    bucket = _key_bucket(named, buckets)
    near = left.withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi")
    there = right.withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi").select(*named)
    keyless = left.where(bucket < 0).select(*target.columns)
    return near.join(there, named, "left_anti").select(*target.columns).unionByName(keyless)


def remove_orphans(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without its orphans."""
    left, right = key_pairs(target, source, keys)
    return left.join(right, right.columns, "left_semi").select(*target.columns)


def remove_orphans_observed(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Callable[[], int]]:
    """As `remove_orphans`, and a function that tells how many rows went, to be called once the result was written.

    There is one join. The rows that stay are counted as they are written, the target's rows without reading a column.
    The number is exact where the result is written as it comes; ahead of another shuffle, tasks that run again would
    count again.
    """
    seen = Observation()
    cleaned = remove_orphans(target, source, keys).observe(seen, F.count(F.lit(1)).alias("kept"))
    return cleaned, lambda: target.count() - seen.get["kept"]


def count_removed(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> int:
    """How many rows `remove_orphans` takes out."""
    return orphan_rows(target, source, keys).count()


def orphan_totals(spark: SparkSession, pairs: Mapping[str, tuple]) -> DataFrame:
    """(table, orphans, status) per table plus a TOTAL row. `pairs`: name -> (target, source, keys).

    A side may also be a function without arguments that gives the DataFrame. Each table is counted by a
    job of its own, so one that cannot be read or compared is reported as failed, without a number, and the
    others are counted all the same. Tables without a key are skipped.
    """
    rows = []
    for name, (target, source, keys) in pairs.items():
        if not keys:
            continue
        try:
            sides = [side() if callable(side) else side for side in (target, source)]
            rows.append((name, count_removed(*sides, keys), "ok"))
        except (PySparkException, Py4JJavaError, ValueError) as failed:
            rows.append((name, None, "failed: " + str(failed).split("\n")[0]))
    if not rows:
        raise ValueError("no table has a key")
    each = spark.createDataFrame(rows, "table string, orphans bigint, status string")
    rolled = each.rollup("table").agg(F.sum("orphans").alias("orphans"), F.first("status").alias("status"),
                                      F.count_if(F.col("status") != "ok").alias("failed"), F.grouping("table").alias("is_total"))
    total = F.col("is_total") == 1
    return rolled.select(F.when(total, "TOTAL").otherwise(F.col("table")).alias("table"),
                         F.when(total, F.coalesce("orphans", F.lit(0))).otherwise(F.col("orphans")).alias("orphans"),
                         F.when(~total, F.col("status")).when(F.col("failed") == 0, "ok").otherwise("incomplete").alias("status"))


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table, also for empty ones. No column is read, only row counts."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _band(lag: Column, far: Column) -> Column:
    return F.when(lag == 0, "synced").when(far, "far behind").otherwise("behind")


def compare_counts(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """(table, source_rows, target_rows, lag, status) per table and a TOTAL row.

    A table far behind lags by more than 5 rows; the total is far behind from 10 rows on.
    """
    joined = (source_counts.withColumnRenamed("rows", "source_rows")
              .join(target_counts.withColumnRenamed("rows", "target_rows"), "table", "full_outer"))
    rolled = joined.rollup("table").agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"), F.grouping("table").alias("is_total"))
    lag = F.col("source_rows") - F.col("target_rows")
    status = F.when(F.col("is_total") == 1, _band(lag, lag >= 10)).otherwise(_band(lag, lag > 5))
    return rolled.select(F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("table")).alias("table"),
                         "source_rows", "target_rows", lag.alias("lag"), status.alias("status"))


def reconcile_counts(source_tables: Mapping[str, DataFrame], target_tables: Mapping[str, DataFrame]) -> DataFrame:
    return compare_counts(count_tables(source_tables), count_tables(target_tables))


def latest_rows(rows: DataFrame, by: str, per: Sequence[str] = (), n: int = 3) -> DataFrame:
    """The n rows with the highest `by` per group (or overall), with their `rank`.

    Of rows with equal `by`, those with smaller values in the other columns come first, in the order of the columns
    and nulls before values, so the rows at the cut are the same in every run. The bounded rank lets Spark keep n rows
    per group in every task before the shuffle, so a group may be of any size.
    """
    ties = [F.col(f.name).asc() for f in rows.schema.fields if f.name not in (by, *per) and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [F.col(by).desc(), *ties]
    if not per:
        top = rows.orderBy(*order).limit(n)
        return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))
    window = Window.partitionBy(*per).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def latest_rows_diff(source: DataFrame, target: DataFrame, by: str, per: Sequence[str], n: int = 3) -> DataFrame:
    """Latest rows of both sides: `side` is 'both', 'source only' or 'target only'.

    Columns come from the source row where there is one, else from the target row.
    """
    keys = [*per, by]
    others = [c for c in source.columns if c not in keys]

    def top(rows: DataFrame, prefix: str) -> DataFrame:
        return latest_rows(rows, by, per, n).select(
            *keys, *[F.col(c).alias(f"{prefix}{c}") for c in others], F.lit(True).alias(f"{prefix}seen"))

    joined = top(source, "s_").join(top(target, "t_"), keys, "full_outer")
    side = (F.when(F.col("s_seen") & F.col("t_seen"), "both").when(F.col("s_seen"), "source only")
            .otherwise("target only"))
    return joined.select(*keys, *[F.when(F.col("s_seen"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
                                  for c in others], side.alias("side"))


def source_rate(samples: DataFrame, interval: float, total: str = "total", by: str = "sample") -> DataFrame:
    """(sample, rate): rows per second at the latest sample, over the last five intervals.

    Only the six latest samples are kept, by a distributed top-k. With fewer samples the rate covers
    the intervals there are.
    """
    last = samples.orderBy(F.col(by).desc()).limit(6)
    change = F.max_by(total, by) - F.min_by(total, by)
    return last.agg(F.max(by).alias("sample"),
                    F.when(F.count("*") > 1, change / ((F.count("*") - 1) * F.lit(float(interval)))).alias("rate"))


def lag_trend(samples: DataFrame, lag: str = "lag", by: str = "sample", n: int = 20) -> DataFrame:
    """(sample, lag, level): level 0 to 7 of the last n samples, relative to their maximum."""
    last = samples.orderBy(F.col(by).desc()).limit(n)
    # The window sees the n rows of the top-k and nothing else.
    highest = F.max(lag).over(Window.partitionBy(F.lit(1)))
    scale = F.when(highest > 0, highest).otherwise(1)
    level = F.when(F.col(lag) > 0, F.least(F.floor(F.col(lag) / scale * 7), F.lit(7))).otherwise(0).cast("int")
    return last.select(by, lag, level.alias("level"))
