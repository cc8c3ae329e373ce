"""Keyed change application: the closed form of replaying a log one event after the other.

Each key is reduced by aggregates that combine on the map side, so a key that holds a third of the log
arrives at the reducer as one row per map task. (Spark sorts by key for aggregates that carry rows or
text; no key's events are ever ordered by position.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordered import DEFAULT_STRETCH, with_previous
from tidemark.session import is_few, joinable
from tidemark.sources.changelog import DELETE, readable

_BARE = "delete without image"


def _key_columns(keys: Sequence[str]) -> list[Column]:
    """The key of an event: from `after` for upserts, from `before` for deletes."""
    return [F.when(F.col("action") == DELETE, F.col(f"before.{k}")).otherwise(F.col(f"after.{k}")).alias(k)
            for k in keys]


def _complete_key(keys: Sequence[str]) -> Column:
    complete = F.lit(True)
    for k in _key_columns(keys):
        complete = complete & k.isNotNull()
    return complete


def applicable(typed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events that change the table: an image is there, its values are readable, its key is complete."""
    return typed.where(F.col("applies") & readable(typed, keys) & _complete_key(keys))


def counted(typed: DataFrame, keys: Sequence[str]) -> Column:
    """Whether progress counts an event: all but those with an image that cannot be applied."""
    return ~F.col("applies") | (readable(typed, keys) & (_complete_key(keys) if keys else F.lit(True)))


def rejected_events(typed: DataFrame, keys: Sequence[str], order_col: str = "seq") -> DataFrame:
    """Events that had an image but cannot be applied, with the reason."""
    reason = (F.when(~readable(typed, keys), "unreadable_value").when(~_complete_key(keys), "incomplete_key"))
    return (typed.where(F.col("applies")).select(order_col, "op", reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def latest_per_key(typed: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   order_col: str = "seq", scope: Sequence[str] = (), position: str | None = None) -> DataFrame:
    """Last event of each key as keys, `deleted` and the other columns. Complete images only.

    `scope` adds grouping columns (such as the table name) in front of the key, `position` the event's position.
    """
    others = [c for c in columns if c not in keys]
    deleted = (F.col("action") == DELETE).alias("deleted")
    # The image of a delete is not needed beyond its key, so it does not travel.
    payload = F.struct(deleted, *[F.when(F.col("action") != DELETE, F.col(f"after.{c}")).alias(c) for c in others])
    return (applicable(typed, keys)
            .select(*scope, *_key_columns(keys), F.col(order_col).alias("_position"), payload.alias("_payload"))
            .groupBy(*scope, *keys).agg(F.max_by("_payload", "_position").alias("_last"), *([F.max("_position").alias(position)] if position else []))
            .select(*scope, *keys, "_last.*", *([position] if position else [])))


def apply_changes(base: DataFrame | None, typed: DataFrame, keys: Sequence[str], order_col: str = "seq",
                  partial: bool = True) -> DataFrame:
    """Current table from a base table and typed changes.

    With `partial` (the default) an update touches only the columns its image carries. Set it to False
    when all images are complete: one aggregate instead of one per column, and the base is only
    anti-joined, which becomes a broadcast join when the batch is small (events are counted up to FEW_ROWS).
    """
    if partial:
        return apply_partial(base, typed, keys, order_col)
    columns = base.columns if base is not None else typed.schema["after"].dataType.names
    last = latest_per_key(typed, keys, columns, order_col)
    survivors = last.where(~F.col("deleted")).select(*columns)
    if base is None:
        return survivors
    # Asking for `deleted` too keeps the aggregate the same on both sides of the union, so that the log is
    # read and shuffled once and the second use is a reused exchange.
    touched = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("deleted").alias("_deleted"))
    same = F.col("_deleted").isNotNull()
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    few = is_few(applicable(typed, keys))
    return base.join(joinable(touched, few), same, "left_anti").select(*columns).unionByName(survivors)


def partial_state(typed: DataFrame, keys: Sequence[str], others: Sequence[str], order_col: str = "seq") -> DataFrame:
    """Per key: position of the last upsert and delete, and per column the last value an upsert carried.

    One pass is enough: the last upsert that carries a column counts exactly if it comes after the last
    delete; if it does not, no later upsert carries the column either. The struct around a value keeps
    an explicit null apart from an absent column.
    """
    is_delete = F.col("action") == DELETE
    rows = applicable(typed, keys).select(
        *_key_columns(keys), F.col(order_col).alias("_position"), is_delete.alias("_deleted"),
        *[F.col(f"after.{c}").alias(f"_v_{c}") for c in others],
        *[F.coalesce(~is_delete & F.col(f"present.{c}"), F.lit(False)).alias(f"_p_{c}") for c in others])
    position = F.col("_position")
    value_of = [F.max_by(F.when(F.col(f"_p_{c}"), F.struct(position.alias("at"), F.col(f"_v_{c}").alias("v"))),
                         F.when(F.col(f"_p_{c}"), position)).alias(f"_s_{c}") for c in others]
    return rows.groupBy(*keys).agg(
        F.max(F.when(~F.col("_deleted"), position)).alias("_upserted"),
        F.max(F.when(F.col("_deleted"), position)).alias("_removed"), *value_of)


def apply_partial(base: DataFrame | None, typed: DataFrame, keys: Sequence[str], order_col: str = "seq") -> DataFrame:
    """As `apply_changes`, for images that leave columns out."""
    columns = base.columns if base is not None else typed.schema["after"].dataType.names
    others = [c for c in columns if c not in keys]
    state = partial_state(typed, keys, others, order_col)
    upserted, removed = F.col("_upserted"), F.col("_removed")
    live = upserted.isNotNull() & (removed.isNull() | (upserted > removed))
    if base is None:
        values = [F.when(removed.isNull() | (F.col(f"_s_{c}.at") > removed), F.col(f"_s_{c}.v")).alias(c) for c in others]
        return state.where(live).select(*keys, *values).select(*columns)
    values = [F.when(removed.isNull(), F.when(F.col(f"_s_{c}").isNotNull(), F.col(f"_s_{c}.v")).otherwise(F.col(c)))
              .when(F.col(f"_s_{c}.at") > removed, F.col(f"_s_{c}.v")).alias(c) for c in others]
    bare = [F.when(removed.isNull() | (F.col(f"_s_{c}.at") > removed), F.col(f"_s_{c}.v")).alias(c) for c in others]
    return _merged(base, state, keys, live, values, bare, is_few(applicable(typed, keys)))


def _merged(base: DataFrame, state: DataFrame, keys: Sequence[str], live: Column, values: Sequence[Column],
            bare: Sequence[Column], few: bool) -> DataFrame:
    """Base rows with the changes of their key, and rows for the keys the base lacks.

    The base only ever streams past the changed keys (an outer and a semi join, broadcast when the events
    are few), so a small batch moves none of it. All three uses of `state` ask for all of its columns, which
    keeps its aggregate the same, and its shuffle is reused.
    """
    all_asked = F.xxhash64(*state.columns) >= F.lit(-(2 ** 63))  # always true
    key_of = {k: f"_k_{k}" for k in keys}
    changes = state.where(all_asked).withColumnsRenamed(key_of)

    def same(left: DataFrame) -> Column:
        match = F.lit(True)
        for k in keys:
            match = match & (left[k] == F.col(f"_k_{k}"))
        return match

    removed = F.col("_removed")
    held = base.join(joinable(changes, few), same(base), "left")
    kept = held.where(F.col(f"_k_{keys[0]}").isNull() | live | removed.isNull()).select(*keys, *values).select(*base.columns)
    known = base.join(joinable(changes, few), same(base), "left_semi").select(*keys)
    fresh = changes.join(joinable(known, few), same(known), "left_anti").where(live)
    return kept.unionByName(fresh.withColumnsRenamed({v: k for k, v in key_of.items()}).select(*keys, *bare).select(*base.columns))


def apply_key_only(base: DataFrame, typed: DataFrame, keys: Sequence[str], order_col: str = "seq") -> DataFrame:
    """Upserts that carry nothing but the key leave an existing row alone; deletes remove it.

    Only two positions per key are aggregated, so the whole reduction is a hash aggregate on longs.
    """
    is_delete = F.col("action") == DELETE
    state = (applicable(typed, keys)
             .select(*_key_columns(keys), F.col(order_col).alias("_position"), is_delete.alias("_deleted"))
             .groupBy(*keys).agg(F.max(F.when(~F.col("_deleted"), F.col("_position"))).alias("_upserted"),
                                 F.max(F.when(F.col("_deleted"), F.col("_position"))).alias("_removed")))
    upserted, removed = F.col("_upserted"), F.col("_removed")
    # A key deleted in between is gone from the base, so it comes back as a bare key.
    live = upserted.isNotNull() & (removed.isNull() | (upserted > removed))
    others = [f for f in base.schema.fields if f.name not in keys]
    return _merged(base, state, keys, live, [F.when(removed.isNull(), F.col(f.name)).alias(f.name) for f in others],
                   [F.lit(None).cast(f.dataType).alias(f.name) for f in others], is_few(applicable(typed, keys)))


def noop_events(base: DataFrame | None, typed: DataFrame, keys: Sequence[str], order_col: str = "seq",
                stretch: int = DEFAULT_STRETCH) -> DataFrame:
    """Deletes without effect: (order_col, keys, reason).

    `no_row`: nothing with that key existed just before. `no_before_image`: the delete had no image.
    """
    # Deletes without an image travel along under an empty key, so that the log is read only once.
    bare = (F.col("action") == DELETE) & ~F.col("has_before")
    usable = F.col("applies") & readable(typed, keys) & _complete_key(keys)
    events = typed.where(usable | bare).select(order_col, F.struct(*_key_columns(keys)).alias("_key"),
                                               F.when(bare, _BARE).otherwise(F.col("action")).alias("action"))
    traced = (with_previous(events, "_key", order_col, "action", "_previous", stretch)
              .select(order_col, "_key.*", "action", "_previous"))
    deletes = traced.where(F.col("action") == DELETE)
    repeated = deletes.where(F.col("_previous") == DELETE).select(order_col, *keys)
    # At most one event per key is the first, so this side has no hot key left.
    first = deletes.where(F.col("_previous").isNull()).select(order_col, *keys)
    if base is not None:
        first = first.join(base.select(*keys), list(keys), "left_anti")
    # Before an event without a key there can only be another one. Saying so keeps the window in this branch,
    # which keeps the filter from moving below the shared exchange.
    keyless = F.coalesce("_previous", F.lit(_BARE)) == _BARE
    imageless = traced.where((F.col("action") == _BARE) & keyless).select(order_col, *keys, F.lit("no_before_image").alias("reason"))
    return repeated.unionByName(first).withColumn("reason", F.lit("no_row")).unionByName(imageless)
