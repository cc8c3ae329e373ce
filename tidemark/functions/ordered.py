"""Neighbours in log order, per key, without sorting a whole key in one task.

A plain window puts all events of a key into one task. Here the log is cut into stretches of
`stretch` positions, the window runs per (key, stretch), and what crosses a border travels as one
row per (key, stretch). Positions are unique, so a task never holds more than `stretch` rows of a key.
The borders may be as many as the rows, so they are never broadcast; the rows are dealt and sorted for the join as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_STRETCH = 1 << 20


def _stretch_of(position: str, stretch: int) -> Column:
    at = F.col(position)
    # Positions are never null; saying so spares a null check that would set the branches of a plan apart.
    return F.coalesce(F.call_function("div", at - F.pmod(at, F.lit(stretch)), F.lit(stretch)), F.lit(0))


def _cut(df: DataFrame, key: str, position: str, stretch: int) -> DataFrame:
    """`df` with the stretch of each row, dealt by key and stretch.

    Given by number, the partitions stay as many as the session has: Spark would otherwise join them into as few as there
    are cores, and their sorts would hold that share of the whole log.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.withColumn("_stretch", _stretch_of(position, stretch)).repartition(parts, key, "_stretch")


def with_previous(df: DataFrame, key: str, position: str, value: str, name: str,
                  stretch: int = DEFAULT_STRETCH) -> DataFrame:
    """Add `name`: `value` of the event just before, per key (null at the first).

    `key` and `value` are never null (a struct of nullable parts will do as a key). `df` is computed and
    shuffled once: the window and the borders read the same exchange.
    """
    cut = _cut(df, key, position, stretch)
    inner = Window.partitionBy(key, "_stretch").orderBy(position)
    outer = Window.partitionBy(key).orderBy("_stretch")
    borders = (cut.groupBy(key, "_stretch").agg(F.max_by(value, position).alias("_last"))
               .select(key, "_stretch", F.lag("_last").over(outer).alias("_carried"))
               .where(F.col("_carried").isNotNull()))
    return (cut.withColumn("_near", F.lag(value).over(inner))
            .join(borders.hint("merge"), [key, "_stretch"], "left")
            .withColumn(name, F.coalesce("_near", "_carried"))
            .select(*df.columns, name))


def with_next_marked(df: DataFrame, key: str, position: str, marked: Column, name: str,
                     stretch: int = DEFAULT_STRETCH) -> DataFrame:
    """Add `name`: position of the next later event of the key for which `marked` holds (null if none)."""
    cut = _cut(df, key, position, stretch)
    mark = F.when(marked, F.col(position))
    # Reading backwards keeps the frame growing, which is linear; strictly later means at least one apart.
    inner = (Window.partitionBy(key, "_stretch").orderBy(F.col(position).desc())
             .rangeBetween(Window.unboundedPreceding, -1))
    outer = (Window.partitionBy(key).orderBy(F.col("_stretch").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    borders = (cut.groupBy(key, "_stretch").agg(F.min(mark).alias("_first"))
               .select(key, "_stretch", F.min("_first").over(outer).alias("_carried"))
               .where(F.col("_carried").isNotNull()))
    return (cut.withColumn("_near", F.min(mark).over(inner))
            .join(borders.hint("merge"), [key, "_stretch"], "left")
            .withColumn(name, F.coalesce("_near", "_carried"))
            .select(*df.columns, name))
