"""Change log: JSON envelopes to flat, classified change events, and typed row images.

Works the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import coerce, decode_record, let

_SCHEMA_FIELDS = ("schema struct<fields:array<struct<field:string,fields:array<"
                  "struct<field:string,name:string,parameters:struct<scale:string>>>>>>")

UPSERT, DELETE, IGNORE = "upsert", "delete", "ignore"


def changelog_text(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON envelope per line, as a `value` column."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format("text").load(path)


def changelog_kafka(spark: SparkSession, servers: str, topics: Iterable[str], streaming: bool = True,
                    options: dict[str, str] | None = None) -> DataFrame:
    """Envelopes from Kafka topics (needs the public Kafka connector on the class path)."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load().withColumn("value", F.col("value").cast("string"))


def parse_changes(raw: DataFrame, order_col: str = "seq", value_col: str = "value",
                  order_field: str | None = None, time_field: str | None = None,
                  field_schemas: bool = False,
                  tables: Iterable[str] | None = None, images: bool = True) -> tuple[DataFrame, DataFrame]:
    """Flatten envelopes into (good, rejected).

    `order_col` is the position of an event in the log: a unique integer, either a column of `raw` or
    read from the envelope field `source.<order_field>`. Columns of `raw` other than the value are kept.
    `time_field` names an epoch-millisecond field of `source` to expose as `event_ms`. With
    `field_schemas` the schema embedded in each envelope is read too, and images come out with their
    decimals decoded. Without `images` the row images stay JSON text: enough for counts, phases and routing.

    Dropped without trace: null and blank values, envelopes without payload, empty table names.
    Rejected: text that is not JSON, and events without a position.
    """
    events = parse_events(raw, order_col, value_col, order_field, time_field, field_schemas, images)
    return split_events(events, order_col, tables)


def parse_events(raw: DataFrame, order_col: str = "seq", value_col: str = "value", order_field: str | None = None,
                 time_field: str | None = None, field_schemas: bool = False, images: bool = True) -> DataFrame:
    """Flat events, good and rejected ones together: what to persist when both are needed."""
    source = ["table:string", "snapshot:string"]
    for name in (order_field, time_field):
        if name and f"{name}:bigint" not in source:
            source.append(f"{name}:bigint")
    if field_schemas and not images:
        raise ValueError("field schemas are of use with images only")
    kind = "map<string,string>" if images else "string"
    schema = f"payload struct<op:string,source:struct<{','.join(source)}>,before:{kind},after:{kind}>, malformed string"
    if field_schemas:
        schema += ", " + _SCHEMA_FIELDS
    parsed = F.from_json(value_col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})
    events = _computed_once(raw, parsed)
    names = ["before", "after"]
    image = {name: F.col(f"payload.{name}") for name in names}
    if not images:
        image = {name: F.when(text.startswith("{"), text) for name, text in image.items()}  # anything else is no image
    if field_schemas:
        schemas = [F.when(image[name].isNotNull(), field_schema_map(F.col("schema.fields"), name)).alias(f"{name}_schema")
                   for name in names]
        events = _computed_once(events, F.struct(*schemas))
        events = _computed_once(events, F.struct(*[decode_record(image[name], F.col(f"{name}_schema")).alias(name)
                                                   for name in names]))
        names += ["before_schema", "after_schema"]
        image = {name: F.col(name) for name in names}
    src, text = F.col("payload.source"), F.col(value_col)
    table = F.coalesce(src["table"], F.lit(""))
    position = src[order_field].alias(order_col) if order_field else F.col(order_col)
    # `malformed` is also set for valid JSON of another shape, which the log format just ignores.
    not_json = F.col("malformed").isNotNull() & (F.trim(text) != "") & F.try_parse_json(text).isNull()
    reason = F.when(not_json, "not_json").when((table != "") & position.isNull(), "no_position")
    kept = [c for c in raw.columns if c not in (value_col, order_col)]
    times = [src[time_field].alias("event_ms")] if time_field else []
    return events.select(
        position, *kept, *times, table.alias("table"),
        F.coalesce(F.col("payload.op"), F.lit("")).alias("op"),
        F.coalesce(src["snapshot"], F.lit("false")).alias("snapshot"), *[image[name].alias(name) for name in names],
        F.when(reason.isNotNull(), text).alias("rejected_value"), reason.alias("reject_reason"),
    ).where(F.col("reject_reason").isNotNull() | (F.col("table") != ""))


def split_events(events: DataFrame, order_col: str = "seq",
                 tables: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of `parse_events`; only good events are filtered by table."""
    wanted = F.col("reject_reason").isNull()
    names = list(tables or ())
    if names:
        wanted = wanted & F.col("table").isin(names)
    good = events.where(wanted).drop("rejected_value", "reject_reason")
    images = ("table", "op", "snapshot", "before", "after", "before_schema", "after_schema")
    kept = [c for c in events.columns if c not in (*images, order_col, "event_ms", "rejected_value", "reject_reason")]
    rejected = (events.where(F.col("reject_reason").isNotNull())
                .select(order_col, *kept, F.col("rejected_value").alias("value"), "reject_reason"))
    return classify(good), rejected


def _computed_once(df: DataFrame, row: Column) -> DataFrame:
    """Add the fields of a struct as columns that are evaluated once.

    The optimizer pushes filters through a projection by copying its expressions, so every predicate on
    a parsed field would parse the JSON again; it does not push them through a generator.
    """
    return df.select("*", F.inline(F.array(row)))


def field_schema_map(fields: Column, image: str) -> Column:
    """Field name to {logical name, scale} of one row image."""
    def entries(named: Column) -> Column:
        return F.map_from_entries(F.transform(named, lambda f: F.struct(
            f["field"].alias("key"),
            F.struct(f["name"].alias("name"), f["parameters"]["scale"].alias("scale")).alias("value"))))

    def unique(named: Column) -> Column:
        # A field listed twice counts as listed last; a map does not take it twice.
        return let(F.transform(named, lambda f: f["field"]), lambda names: F.when(
            F.size(F.array_distinct(names)) == F.size(names), named).otherwise(
            F.filter(named, lambda f, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), f["field"]))))

    struct = F.get(F.filter(fields, lambda f: f["field"] == image), F.lit(0))
    named = F.filter(struct["fields"], lambda f: f["field"].isNotNull())
    return let(named, lambda n: entries(unique(n)))


def stage_of(snapshot: Column) -> Column:
    """Snapshot flag to 'stream', 'last' (end of the snapshot) or 'snapshot'."""
    flag = F.coalesce(snapshot, F.lit("false"))
    return F.when(flag.isin("false", ""), "stream").when(flag == "last", "last").otherwise("snapshot")


def classify(events: DataFrame) -> DataFrame:
    """Add stage, action, counted_as and applies to flat events."""
    op = F.col("op")
    action = F.when(op.isin("r", "c", "u"), UPSERT).when(op == "d", DELETE).otherwise(IGNORE)
    counted = (F.when(op == "r", "SNAPSHOT").when(op == "c", "INSERT")
               .when(op == "u", "UPDATE").when(op == "d", "DELETE"))
    applies = (op.isin("r", "c", "u") & F.col("after").isNotNull()) | ((op == "d") & F.col("before").isNotNull())
    return events.withColumns({"stage": stage_of(F.col("snapshot")), "action": action,
                               "counted_as": counted, "applies": applies})


def route_by_table(events: DataFrame, tables: Iterable[str]) -> dict[str, DataFrame]:
    """One DataFrame per table. Nothing is shuffled by table name, so a table may hold most of the log."""
    return {name: events.where(F.col("table") == name) for name in tables}


def _lower_keys(image: Column) -> Column:
    """An image with its column names in lower case; nearly always it has them already."""
    def fold(entries: Column) -> Column:
        lowered = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        later = lambda i: F.transform(F.slice(lowered, i + 2, F.size(lowered)), lambda e: e["key"])
        return F.map_from_entries(F.filter(lowered, lambda e, i: ~F.array_contains(later(i), e["key"])))

    return F.when(F.exists(F.map_keys(image), lambda k: k != F.lower(k)), fold(F.map_entries(image))).otherwise(image)


def decode_images(good: DataFrame, schema: T.StructType, units: dict[str, str] | None = None,
                  time_columns: Iterable[str] = (), keys: Iterable[str] = ()) -> DataFrame:
    """Typed row images for the events of one table (or of tables that share a schema).

    `before` and `after` become structs of the target schema, and `present` a struct of booleans
    saying which columns the relevant image carries (`after`, or `before` for deletes). `unread_before`
    and `unread_after` flag the columns whose value cannot be typed; see `split_readable`. Columns are
    matched whatever their case; of two that differ in case only, the last of the image counts. With `keys`
    only these columns of the before image are typed: a keyed table needs no others.
    """
    names = [f.name.lower() for f in schema.fields]
    if len(set(names)) < len(names):
        raise ValueError("column names that differ in case only")
    units = units or {}
    times = set(time_columns)
    keys = list(keys)
    is_delete = F.col("action") == DELETE
    fields = {"after": schema.fields, "before": [f for f in schema.fields if not keys or f.name in keys]}

    def typed(image: str) -> Column:
        return F.struct(*[coerce(F.col(f"raw_{image}")[f.name.lower()], f.dataType, units.get(f.name, "ms"), f.name in times)
                          .alias(f.name) for f in fields[image]])

    relevant = F.when(is_delete, F.col("raw_before")).otherwise(F.col("raw_after"))
    present = F.struct(*[F.map_contains_key(relevant, F.lit(f.name.lower())).alias(f.name) for f in schema.fields])
    flat = good.withColumns({f"raw_{image}": _lower_keys(F.col(image)) for image in ("before", "after")}).drop("before", "after")
    flat = _computed_once(flat, F.struct(typed("before").alias("before"), typed("after").alias("after")))

    # One flag per column: a value is there but could not be typed. Text always passes.
    def unread(image: str) -> Column:
        flags = [(F.col(f"raw_{image}")[f.name.lower()].isNotNull() & F.col(image)[f.name].isNull()).alias(f.name)
                 if not isinstance(f.dataType, T.StringType) else F.lit(False).alias(f.name) for f in fields[image]]
        return F.struct(*flags).alias(f"unread_{image}")

    extra = [c for c in good.columns if c not in ("before", "after", "before_schema", "after_schema")]
    return flat.select(*extra, "before", "after", present.alias("present"), F.col("raw_before").isNotNull().alias("has_before"),
                       unread("before"), unread("after"))


def _all_read(typed: DataFrame, image: str, names: Iterable[str] | None = None) -> Column:
    fields = typed.schema[f"unread_{image}"].dataType.names
    ok = F.lit(True)
    for name in fields if names is None else names:
        ok = ok & ~F.coalesce(F.col(f"unread_{image}.{name}"), F.lit(False))
    return ok


def readable(typed: DataFrame, keys: Iterable[str] = ()) -> Column:
    """True for events of `decode_images` whose needed values could all be typed.

    A keyed delete needs its key only, and keyed upserts never look at the before image.
    """
    keys = list(keys)
    after_ok = _all_read(typed, "after")
    if keys:
        return F.when(F.col("action") == DELETE, _all_read(typed, "before", keys)).otherwise(after_ok)
    before_ok = _all_read(typed, "before")
    return (F.when(F.col("action") == DELETE, before_ok)
            .when(F.col("op") == "u", before_ok & after_ok).otherwise(after_ok))


def unread_columns(typed: DataFrame, image: str) -> Column:
    """Names of the columns of an image that could not be typed, for reports."""
    fields = typed.schema[f"unread_{image}"].dataType.names
    return F.array_compact(F.array(*[F.when(F.col(f"unread_{image}.{n}"), F.lit(n)) for n in fields]))


def split_readable(typed: DataFrame, keys: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Events that can be applied, and those that must be skipped (neither applied nor counted)."""
    ok = readable(typed, keys)
    return typed.where(ok), typed.where(~ok)
