"""Sharding by jump consistent hashing: no ring table, and a new shard takes rows only into itself.

The key walks a 64-bit linear congruential generator; every step jumps to the next bucket the key would move to if
buckets were appended one by one, and the last bucket below the number of shards is its own (Lamping and Veach, "A
fast, minimal memory, consistent hash algorithm"). Products modulo 2^64 are exact decimals of at most 38 digits, so
built-in functions do all of it.

Nulls: a null id counts as 0, a null text as no bytes. Equal rows go to the same shard and get different slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the published algorithm: multiplier and word size.
MULTIPLIER, WORD = "2862933555777941757", "18446744073709551616"
#: Rows numbered by one task at a time, on average.
BLOCK_ROWS = 20_000


def _first_state(key: Column) -> Column:
    wide = F.coalesce(key, F.lit(0)).cast("decimal(20,0)")
    return F.when(wide < 0, wide + F.lit(WORD).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def _next_state(state: Column) -> Column:
    product = state * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
    return (product % F.lit(WORD).cast("decimal(20,0)")).cast("decimal(20,0)")


def jump_shard(key: Column, shards: int) -> Column:
    """The shard 0 to `shards` - 1 of an integer key."""
    def step(at: Column, _: Column) -> Column:
        state = _next_state(at["state"])
        high = F.floor(state / F.lit(1 << 33).cast("decimal(20,0)")).cast("double") + F.lit(1.0)
        to = ((at["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / high)).cast("bigint")
        moved = F.struct(at["next"].alias("bucket"), to.alias("next"), state.alias("state"))
        return F.when(at["next"] < shards, moved).otherwise(at)

    start = F.struct(F.lit(-1).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("next"), _first_state(key).alias("state"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda at: at["bucket"].cast("int"))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Slots count from 0 in each shard without gaps: rows are numbered within blocks of a shard, and the blocks' sizes
    are summed up beforehand. So no task holds a shard, however few shards there are.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    blocks = max(1, -(-docs.count() // (block_rows * shards)))
    block = (_next_state(_first_state(key)) % F.lit(blocks).cast("decimal(20,0)")).cast("int")
    placed = docs.select(key.alias("doc_id"), (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                         jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard"), block.alias("block"))
    sizes = docs.select(jump_shard(key, shards).alias("shard"), block.alias("block")).groupBy("shard", "block").agg(F.count("*").alias("rows"))
    before = sizes.selectExpr("shard", "block", "coalesce(sum(rows) OVER (PARTITION BY shard ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    numbered = placed.withColumn("at", F.expr("row_number() OVER (PARTITION BY shard, block ORDER BY doc_id, size, text_crc32)"))
    return numbered.join(before, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("at") - 1).cast("bigint").alias("slot"), "grown_shard")
