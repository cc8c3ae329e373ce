"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import decode as D
from tidemark.operators import catalog as C
from tidemark.operators import checks, merge, progress, reconcile, unkeyed
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import changelog, snapshot
from tidemark.sources.bucket_store import BucketStore
from tidemark.sources.changelog import decode_images, parse_changes
from workload import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_COLUMNS = ["id", "event_type", "value"]


def query(function: Query) -> Query:
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def events_of(spark: SparkSession, sf_dir: str, make=X.event_envelopes, **options) -> DataFrame:
    return parse_changes(make(spark, sf_dir), **options)[0]


def typed_events(spark: SparkSession, sf_dir: str, make=X.event_envelopes) -> DataFrame:
    """Events of all three tables. An id belongs to one table (`user_id % 3`), so it is a key across them."""
    return decode_images(events_of(spark, sf_dir, make), X.EVENT_SCHEMA)


# --- scans ----------------------------------------------------------------------------------------------

@query
def q_snapshot_scan(spark, sf_dir):
    rows = snapshot.snapshot_scan(X.load(spark, sf_dir, "orders"), "orders")
    return rows.select("table", "op", "counted_as", "after.o_orderkey", "after.o_custkey", "after.o_totalprice")


@query
def q_changelog_scan(spark, sf_dir):
    row = F.when(F.col("action") == "delete", F.col("before")).otherwise(F.col("after"))
    return typed_events(spark, sf_dir).select("seq", "table", "op", row.alias("r")).select("seq", "table", "op", "r.*")


@query
def q_table_select(spark, sf_dir):
    return events_of(spark, sf_dir, tables=["orders", "users"], images=False).select("seq", "table", "op")


def _mode(spark, sf_dir, mode, **sides):
    base = snapshot.base_for_mode(spark, mode, X.EVENT_SCHEMA, **sides)
    typed = snapshot.events_for_mode(typed_events(spark, sf_dir), mode)
    return merge.apply_changes(base, typed, ["id"], partial=False)


@query
def q_snapshot_mode_initial(spark, sf_dir):
    return _mode(spark, sf_dir, "initial", snapshot=X.customers_as_rows(spark, sf_dir))


@query
def q_snapshot_mode_never(spark, sf_dir):
    return _mode(spark, sf_dir, "never", target=X.suppliers_as_rows(spark, sf_dir))


@query
def q_snapshot_mode_schema_only(spark, sf_dir):
    return _mode(spark, sf_dir, "schema_only")


@query
def q_snapshot_mode_initial_only(spark, sf_dir):
    return _mode(spark, sf_dir, snapshot.effective_mode("kingbase"), snapshot=X.customers_as_rows(spark, sf_dir))


# --- envelopes ------------------------------------------------------------------------------------------

@query
def q_envelope_flatten(spark, sf_dir):
    return events_of(spark, sf_dir).select(
        "seq", "table", "op", "snapshot", F.col("before")["id"].alias("before_id"), F.col("after")["id"].alias("after_id"),
        F.col("after")["event_type"].alias("after_event_type"))


@query
def q_event_filter(spark, sf_dir):
    return events_of(spark, sf_dir, X.dirty_envelopes, images=False).select("seq", "table", "op")


@query
def q_event_quarantine(spark, sf_dir):
    return parse_changes(X.dirty_envelopes(spark, sf_dir))[1].select("seq", "value", "reject_reason")


@query
def q_op_classify(spark, sf_dir):
    return events_of(spark, sf_dir, X.dirty_envelopes, images=False).select("seq", "op", "action", "counted_as", "applies")


@query
def q_snapshot_flag(spark, sf_dir):
    return events_of(spark, sf_dir, X.dirty_envelopes, images=False).select("seq", "snapshot", "stage")


@query
def q_route_by_table(spark, sf_dir):
    routes = changelog.route_by_table(events_of(spark, sf_dir), X.TABLES)
    parts = [events.select(F.lit(name).alias("route"), "seq", "op") for name, events in routes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def q_field_schema_map(spark, sf_dir):
    events = events_of(spark, sf_dir, X.decimal_envelopes, field_schemas=True)
    return (events.select("seq", F.explode("after_schema").alias("field", "s"))
            .select("seq", "field", F.col("s.name").alias("logical_name"), F.col("s.scale").alias("scale")))


@query
def q_image_typed(spark, sf_dir):
    typed = typed_events(spark, sf_dir, X.partial_envelopes)
    return typed.where("action = 'upsert'").select("seq", "after.*", F.col("present.value").cast("int").alias("value_present"))


@query
def q_image_typed_case(spark, sf_dir):
    """Column names in three spellings."""
    typed = typed_events(spark, sf_dir, X.mixed_case_envelopes)
    return typed.where("action = 'upsert'").select("seq", "after.*", F.col("present.value").cast("int").alias("value_present"))


# --- decoding -------------------------------------------------------------------------------------------

@query
def q_decimal_decode_wide(spark, sf_dir):
    """Values of 20 to 65 digits and both signs, as text."""
    wires = F.array(*[F.lit(wire) for wire, _ in X.wide_decimals()])
    chosen = F.element_at(wires, (F.col("o_orderkey") % len(X.wide_decimals()) + 1).cast("int"))
    return X.load(spark, sf_dir, "orders").select("o_orderkey", D.decode_decimal_text(chosen, F.lit("7")).alias("price"))


@query
def q_decimal_decode(spark, sf_dir):
    wire = X.load(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{X.WIRE_CENTS} AS wire", f"{X.SCALE} AS scale")
    return wire.select("o_orderkey", D.decode_decimal(F.col("wire"), 2, 18, 2).alias("price"),
                       D.decode_decimal(F.col("wire"), F.col("scale"), 18, 4).alias("scaled"))


@query
def q_record_decode(spark, sf_dir):
    image = F.col("after")
    return events_of(spark, sf_dir, X.decimal_envelopes, field_schemas=True).select(
        "seq", image["id"].alias("id"), image["price"].cast("decimal(18,4)").alias("price"), image["code"].alias("code"))


def _wire(spark, sf_dir, *expressions):
    """Values as they travel: every tenth one is null."""
    return X.load(spark, sf_dir, "events").selectExpr(
        "event_id", *[f"if(event_id % 10 = 9, null, {e}) AS {name}" for name, e in expressions])


_MILLIS = "cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as string)"
_LOCAL = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"


@query
def q_coerce_boolean(spark, sf_dir):
    wire = _wire(spark, sf_dir, ("flag", "cast(event_id % 3 as string)"), ("ratio", "cast(value / 100 as string)"),
                 ("word", "if(event_id % 2 = 0, 'true', 'false')"))
    return wire.select("event_id", *[D.to_boolean(F.col(c)).cast("int").alias(c) for c in ("flag", "ratio", "word")])


@query
def q_coerce_timestamp(spark, sf_dir):
    wire = _wire(spark, sf_dir, ("millis", _MILLIS), ("local_text", _LOCAL), ("zoned", f"concat({_LOCAL}, '+02:00')"),
                 ("utc", f"concat({_LOCAL}, 'Z')"))
    return wire.select("event_id", *[D.to_timestamp_ntz(F.col(c)).alias(c) for c in ("millis", "local_text", "zoned", "utc")])


@query
def q_coerce_timestamptz(spark, sf_dir):
    wire = _wire(spark, sf_dir, ("millis", _MILLIS), ("zoned", f"concat({_LOCAL}, '-03:30')"), ("no_offset", _LOCAL))
    return wire.select("event_id", *[F.unix_millis(D.to_timestamp_tz(F.col(c))).alias(c) for c in ("millis", "zoned", "no_offset")])


@query
def q_coerce_date(spark, sf_dir):
    wire = _wire(spark, sf_dir, ("days", "cast(datediff(ts, date'1970-01-01') as string)"), ("iso", "cast(cast(ts as date) as string)"))
    return wire.select("event_id", *[D.to_date(F.col(c)).cast("string").alias(c) for c in ("days", "iso")])


@query
def q_coerce_time(spark, sf_dir):
    since_midnight = "cast(timestampdiff(MILLISECOND, date_trunc('DAY', ts), ts) as string)"
    wire = _wire(spark, sf_dir, ("millis", since_midnight), ("micros", f"concat({since_midnight}, '000')"), ("plain", "'12:34:56'"))
    return wire.select("event_id", D.to_time_text(F.col("millis")).alias("millis"),
                       D.to_time_text(F.col("micros"), "us").alias("micros"), D.to_time_text(F.col("plain")).alias("plain"))


@query
def q_key_normalize(spark, sf_dir):
    """An int key on one side meets a decimal key on the other."""
    orders = X.load(spark, sf_dir, "orders")
    target = orders.select(F.col("o_orderkey").cast("int").alias("key"), "o_orderstatus")
    source = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("decimal(12,0)").alias("key"))
    left, right = reconcile.key_pairs(target, source, ["key"])
    return left.join(right, ["_k0"], "left_semi").select(F.col("_k0").alias("key"), "o_orderstatus")


# --- change application -----------------------------------------------------------------------------------

@query
def q_apply_changes(spark, sf_dir):
    """The state of three tables after the whole log, in one plan."""
    last = merge.latest_per_key(typed_events(spark, sf_dir), ["id"], EVENT_COLUMNS, scope=["table"])
    return last.where(~F.col("deleted")).select("table", *EVENT_COLUMNS)


@query
def q_apply_upserts(spark, sf_dir):
    typed = typed_events(spark, sf_dir).where("action = 'upsert'")
    return merge.apply_changes(X.customers_as_rows(spark, sf_dir), typed, ["id"], partial=False)


@query
def q_apply_deletes(spark, sf_dir):
    typed = typed_events(spark, sf_dir).where("action = 'delete'")
    return merge.apply_changes(X.customers_as_rows(spark, sf_dir), typed, ["id"], partial=False)


@query
def q_apply_changes_on_base(spark, sf_dir):
    typed = decode_images(events_of(spark, sf_dir, X.order_envelopes), X.ORDER_SCHEMA)
    base = X.orders_target(spark, sf_dir).select(*X.ORDER_SCHEMA.names)
    return merge.apply_changes(base, typed, ["o_orderkey"], partial=False)


@query
def q_apply_changes_composite(spark, sf_dir):
    typed = decode_images(events_of(spark, sf_dir, X.line_envelopes), X.LINE_SCHEMA)
    return merge.apply_changes(None, typed, X.LINE_KEYS, partial=False)


@query
def q_apply_partial(spark, sf_dir):
    typed = typed_events(spark, sf_dir, X.partial_envelopes)
    return merge.apply_partial(X.customers_as_rows(spark, sf_dir), typed, ["id"])


@query
def q_apply_key_only(spark, sf_dir):
    typed = typed_events(spark, sf_dir, X.key_only_envelopes)
    return merge.apply_key_only(X.suppliers_as_rows(spark, sf_dir), typed, ["id"])


def _bag(spark, sf_dir, op):
    typed = decode_images(events_of(spark, sf_dir, lambda s, d: X.bag_envelopes(s, d, op)), X.BAG_SCHEMA)
    return unkeyed.apply_unkeyed(X.line_bag(spark, sf_dir), typed)


@query
def q_apply_unkeyed_insert(spark, sf_dir):
    return _bag(spark, sf_dir, "c")


@query
def q_apply_unkeyed_update(spark, sf_dir):
    return _bag(spark, sf_dir, "u")


@query
def q_apply_unkeyed_delete(spark, sf_dir):
    return _bag(spark, sf_dir, "d")


@query
def q_apply_unkeyed_chain(spark, sf_dir):
    """Updates that build on one another."""
    typed = decode_images(events_of(spark, sf_dir, X.chained_bag_envelopes), X.STATE_SCHEMA)
    return unkeyed.apply_unkeyed(None, typed)


@query
def q_apply_unkeyed_partial(spark, sf_dir):
    """Updates that set some columns of the rows they find."""
    typed = decode_images(events_of(spark, sf_dir, X.partial_bag_envelopes), X.PARTIAL_STATE_SCHEMA)
    return unkeyed.apply_unkeyed(None, typed)


@query
def q_noop_unkeyed_partial(spark, sf_dir):
    typed = decode_images(events_of(spark, sf_dir, X.partial_bag_envelopes), X.PARTIAL_STATE_SCHEMA)
    return unkeyed.unkeyed_noop_events(None, typed)


@query
def q_apply_reordered(spark, sf_dir):
    """The log in four batches, the last first, each rewriting only the buckets that it changes."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/reordered-{uuid.uuid4().hex}"
    store = BucketStore(spark, folder, X.EVENT_SCHEMA, ["id"], buckets=16)
    store.load(X.customers_as_rows(spark, sf_dir))
    typed = typed_events(spark, sf_dir, X.partial_envelopes)
    for batch in (3, 1, 0, 2):
        store.apply(store.changes(typed.where(F.col("seq") % 4 == batch)))
    return store.read()


@query
def q_noop_unkeyed(spark, sf_dir):
    """Deletes that met no row, and updates that inserted one because they met none."""
    typed = decode_images(events_of(spark, sf_dir, X.chained_bag_envelopes), X.STATE_SCHEMA)
    return unkeyed.unkeyed_noop_events(None, typed)


@query
def q_noop_deletes(spark, sf_dir):
    return merge.noop_events(X.suppliers_as_rows(spark, sf_dir), typed_events(spark, sf_dir), ["id"],
                             stretch=1000)


# --- reconciliation -----------------------------------------------------------------------------------------

@query
def q_orphan_rows(spark, sf_dir):
    return reconcile.orphan_rows(X.orders_target(spark, sf_dir), X.load(spark, sf_dir, "orders"), ["o_orderkey"])


@query
def q_orphan_rows_composite(spark, sf_dir):
    found = reconcile.orphan_rows(X.lineitem_target(spark, sf_dir), X.load(spark, sf_dir, "lineitem"), X.LINE_KEYS)
    return found.select(*X.LINE_KEYS, "l_quantity")


@query
def q_orphan_rows_pruned(spark, sf_dir):
    """Buckets of keys whose digests agree on both sides are not joined."""
    found = reconcile.orphan_rows_pruned(X.lineitem_target(spark, sf_dir), X.load(spark, sf_dir, "lineitem"), X.LINE_KEYS)
    return found.select(*X.LINE_KEYS, "l_quantity")


@query
def q_orphan_cleanup(spark, sf_dir):
    return reconcile.remove_orphans(X.orders_target(spark, sf_dir), X.load(spark, sf_dir, "orders"), ["o_orderkey"])


@query
def q_orphans_removed(spark, sf_dir):
    """How many rows a cleanup took out, told by the cleanup itself while its result is written."""
    cleaned, removed = reconcile.remove_orphans_observed(X.lineitem_target(spark, sf_dir), X.load(spark, sf_dir, "lineitem"), X.LINE_KEYS)
    cleaned.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([("lineitem", removed())], "table string, removed bigint")


@query
def q_orphan_totals(spark, sf_dir):
    return reconcile.orphan_totals(spark, {
        "orders": (X.orders_target(spark, sf_dir), X.load(spark, sf_dir, "orders"), ["o_orderkey"]),
        "lineitem": (X.lineitem_target(spark, sf_dir), X.load(spark, sf_dir, "lineitem"), X.LINE_KEYS),
        "customer": (X.load(spark, sf_dir, "customer"), X.load(spark, sf_dir, "customer"), ["c_custkey"]),
        "events": (X.load(spark, sf_dir, "events"), X.load(spark, sf_dir, "events"), [])})


@query
def q_cleanup_trigger(spark, sf_dir):
    return progress.cleanup_trigger(events_of(spark, sf_dir, images=False))


@query
def q_reconcile_counts(spark, sf_dir):
    source = {t: X.load(spark, sf_dir, t) for t in ("customer", "events", "lineitem", "orders", "part", "region")}
    target = {"customer": source["customer"], "events": source["events"], "lineitem": X.lineitem_target(spark, sf_dir),
              "orders": X.orders_target(spark, sf_dir), "part": X.load(spark, sf_dir, "supplier"),
              "nation": X.load(spark, sf_dir, "nation")}
    return reconcile.reconcile_counts(source, target)


@query
def q_latest_rows(spark, sf_dir):
    rows = reconcile.latest_rows(X.load(spark, sf_dir, "orders"), "o_orderkey", ["o_orderstatus"])
    return rows.select("o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice", F.col("rank").cast("bigint").alias("rank"))


@query
def q_latest_rows_diff(spark, sf_dir):
    keep = ["o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice"]
    return reconcile.latest_rows_diff(X.load(spark, sf_dir, "orders").select(*keep), X.lagging_orders(spark, sf_dir).select(*keep),
                                      "o_orderkey", ["o_orderstatus"])


@query
def q_source_rate(spark, sf_dir):
    return reconcile.source_rate(X.hourly_samples(spark, sf_dir), 3600.0)


@query
def q_lag_trend(spark, sf_dir):
    return reconcile.lag_trend(X.hourly_samples(spark, sf_dir))


# --- progress -------------------------------------------------------------------------------------------------

def _registered(spark, sf_dir):
    """Tables of the log, one that has no events, and one per market segment that has none either."""
    known = X.event_log(spark, sf_dir).selectExpr("table_name AS table")
    return known.unionByName(X.load(spark, sf_dir, "customer").selectExpr("lower(c_mktsegment) AS table")).distinct()


def _totals(spark, sf_dir):
    """Expected snapshot sizes, from the customers; none for users."""
    return X.load(spark, sf_dir, "customer").selectExpr(
        "CASE c_custkey % 3 WHEN 1 THEN 'orders' WHEN 2 THEN 'products' ELSE 'unused' END AS table").groupBy("table").agg(
        F.count("*").alias("total"))


def _progress(spark, sf_dir, events=None, **sides):
    events = events if events is not None else events_of(spark, sf_dir, images=False)
    return progress.progress(events, time_col="event_ts", **sides)


@query
def q_progress_counts(spark, sf_dir):
    return _progress(spark, sf_dir, events_of(spark, sf_dir, X.dirty_envelopes, images=False)).select(
        "table", "snapshot_rows", "inserts", "updates", "deletes", "last_event")


@query
def q_progress_merged(spark, sf_dir):
    """Counts and phases from the states of three parts of the log, merged in another order."""
    events = events_of(spark, sf_dir, X.priority_envelopes, images=False)
    parts = [progress.progress_state(events.where(F.col("seq") % 3 == i)) for i in (2, 0, 1)]
    return progress.progress_of(progress.merge_progress(*parts), registered=_registered(spark, sf_dir)).select(
        "table", "phase", "snapshot_rows", "inserts", "updates", "deletes", "changes")


@query
def q_progress_totals(spark, sf_dir):
    return progress.with_overall(_progress(spark, sf_dir))


@query
def q_progress_phase(spark, sf_dir):
    """One table per order status and priority; whichever event came last decides."""
    events = events_of(spark, sf_dir, X.priority_envelopes, images=False)
    return progress.progress(events, registered=_registered(spark, sf_dir)).select("table", "phase")


@query
def q_snapshot_pct(spark, sf_dir):
    return _progress(spark, sf_dir, totals=_totals(spark, sf_dir)).select(
        "table", "snapshot_rows", "total", F.round("snapshot_pct", 6).alias("snapshot_pct"), "snapshot_label")


@query
def q_status_report(spark, sf_dir):
    per_table = _progress(spark, sf_dir, registered=_registered(spark, sf_dir), totals=_totals(spark, sf_dir))
    return progress.status_report(per_table, F.expr("timestamp_ntz'2024-01-31 00:00:00'"))


# --- checks and schemas ------------------------------------------------------------------------------------------

MYSQL_TYPES = [s for s, _ in C.type_pairs("mysql")] + [
    "INT(11)", "varchar(20)", "Date Unsigned", "GEOGRAPHY", "tinyint", " decimal ", "enum('a','b')"]
POSTGRES_TYPES = [s for s, _ in C.type_pairs("postgresql")] + ["_int4", "varchar(20)", "numeric", "HSTORE", "bpchar"]


def _catalogs(spark, sf_dir, types=None):
    source = X.part_catalog(spark, sf_dir, types or MYSQL_TYPES)
    return source, X.part_target_catalog(source)


@query
def q_missing_tables(spark, sf_dir):
    _, target = _catalogs(spark, sf_dir)
    return checks.missing_tables(X.required_tables(spark, sf_dir), target).select("table")


@query
def q_table_checks(spark, sf_dir):
    source, target = _catalogs(spark, sf_dir)
    rows = checks.table_checks(X.required_tables(spark, sf_dir), source, target)
    return rows.select("id", "status", "message", F.array_join("details", "; ").alias("details"))


@query
def q_check_summary(spark, sf_dir):
    source, target = _catalogs(spark, sf_dir)
    status = F.expr("CASE action WHEN 'create' THEN 'FAIL' WHEN 'alter' THEN 'WARN' ELSE 'PASS' END")
    return checks.check_summary(C.schema_plan(source, target).select(status.alias("status")))


GIVEN_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
              "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": X.LINE_KEYS, "events": ["event_id"]}


@query
def q_schema_catalog(spark, sf_dir):
    tables = {name: X.load(spark, sf_dir, name) for name in GIVEN_KEYS}
    catalog = C.catalog_of(spark, tables, GIVEN_KEYS)
    return (catalog.join(F.broadcast(reconcile.count_tables(tables)), "table")
            .select("table", "column", "type_name", "ordinal", "key_seq", "rows"))


@query
def q_pk_columns(spark, sf_dir):
    return C.pk_columns(_catalogs(spark, sf_dir)[0]).select("table", F.array_join("keys", ",").alias("keys"))


@query
def q_translate_mysql_pg(spark, sf_dir):
    source, _ = _catalogs(spark, sf_dir)
    return C.translate_types(source, "mariadb", "postgresql").select("table", "column", "type_name", "target_type")


@query
def q_translate_pg_mysql(spark, sf_dir):
    source, _ = _catalogs(spark, sf_dir, POSTGRES_TYPES)
    return C.translate_types(source, "kingbase", "mysql").select("table", "column", "type_name", "target_type")


@query
def q_translate_same_family(spark, sf_dir):
    source, _ = _catalogs(spark, sf_dir)
    return C.translate_types(source, "mysql", "mariadb").select("table", "column", "type_name", "target_type")


@query
def q_schema_diff(spark, sf_dir):
    return C.schema_diff(*_catalogs(spark, sf_dir)).select("table", "column")


@query
def q_schema_plan(spark, sf_dir):
    return C.schema_plan(*_catalogs(spark, sf_dir))


@query
def q_schema_evolve(spark, sf_dir):
    wanted = T.StructType([T.StructField("O_ORDERKEY", T.LongType()), T.StructField("discount", T.DecimalType(10, 2)),
                           T.StructField("note", T.StringType())])
    return C.evolve(X.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), wanted)


@query
def q_create_ddl(spark, sf_dir):
    return C.create_ddl(_catalogs(spark, sf_dir)[0], "mysql", "postgresql")


@query
def q_alter_ddl(spark, sf_dir):
    source, target = _catalogs(spark, sf_dir, POSTGRES_TYPES)
    return C.alter_ddl(source, target, "postgresql", "mysql")
