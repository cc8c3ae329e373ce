"""Inputs of the registered queries, derived from the given tables inside the query plan."""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["orders", "products", "users"]

EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat change log over three tables, keyed by (table_name, id), ordered by seq."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_id AS seq", "ts AS event_ts",
        "CASE user_id % 3 WHEN 0 THEN 'users' WHEN 1 THEN 'orders' ELSE 'products' END AS table_name",
        "user_id AS id",
        "CASE WHEN event_id < 200 THEN 'r' WHEN event_type IN ('signup', 'view') THEN 'c' "
        "WHEN event_type IN ('click', 'purchase') THEN 'u' ELSE 'd' END AS op",
        "CASE WHEN event_id < 199 THEN 'true' WHEN event_id = 199 THEN 'last' ELSE 'false' END AS snapshot",
        "event_type", "value", "event_id % 3 <> 0 AS has_value", "event_id % 5 = 0 AS null_value")


def _envelope(before: str, after: str, table: str = "table_name", op: str = "op", snapshot: str = "snapshot") -> str:
    return (f"to_json(named_struct('payload', named_struct('op', {op}, 'source', named_struct('table', {table}, "
            f"'snapshot', {snapshot}), 'before', {before}, 'after', {after})), map('ignoreNullFields', 'false'))")


FULL_IMAGE = "named_struct('id', id, 'event_type', event_type, 'value', value)"
KEY_IMAGE = "named_struct('id', id)"
# A map, so that a column can be left out: value is absent, an explicit null, or a number.
PARTIAL_IMAGE = ("map_filter(map('id', cast(id as string), 'event_type', event_type, "
                 "'value', if(null_value, null, cast(value as string))), (k, v) -> k <> 'value' OR has_value)")
_NO_ROW = "cast(null as struct<id:bigint,event_type:string,value:double>)"
_NO_MAP = "cast(null as map<string,string>)"


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as JSON envelopes with complete images: (seq, event_ts, value)."""
    text = _envelope(f"if(op IN ('u', 'd'), {FULL_IMAGE}, {_NO_ROW})", f"if(op = 'd', {_NO_ROW}, {FULL_IMAGE})")
    return event_log(spark, sf_dir).selectExpr("seq", "event_ts", f"{text} AS value")


def partial_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with partial images: a third lacks the value, a fifth sets it to null."""
    key_map = "map('id', cast(id as string))"
    text = _envelope(f"if(op = 'd', {key_map}, {_NO_MAP})", f"if(op = 'd', {_NO_MAP}, {PARTIAL_IMAGE})")
    return event_log(spark, sf_dir).selectExpr("seq", "event_ts", f"{text} AS value")


def mixed_case_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with partial images, its columns spelt in one of three ways."""
    text = """CASE seq % 3 WHEN 0 THEN value WHEN 1 THEN replace(replace(value, '"id"', '"ID"'), '"event_type"', '"Event_Type"')
              ELSE replace(replace(value, '"value"', '"VALUE"'), '"id"', '"Id"') END AS value"""
    return partial_envelopes(spark, sf_dir).selectExpr("seq", "event_ts", text)


def key_only_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with images that carry the key and nothing else."""
    none = "cast(null as struct<id:bigint>)"
    text = _envelope(f"if(op = 'd', {KEY_IMAGE}, {none})", f"if(op = 'd', {none}, {KEY_IMAGE})")
    return event_log(spark, sf_dir).selectExpr("seq", "event_ts", f"{text} AS value")


def dirty_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with damaged and unusual lines mixed in, chosen by seq % 29."""
    full = _envelope(f"if(op IN ('u', 'd'), {FULL_IMAGE}, {_NO_ROW})", f"if(op = 'd', {_NO_ROW}, {FULL_IMAGE})")
    no_table = _envelope(_NO_ROW, FULL_IMAGE, table="''")
    other_op = _envelope(_NO_ROW, FULL_IMAGE, op="'t'")
    no_images = _envelope(_NO_ROW, _NO_ROW)
    empty_flag = _envelope(_NO_ROW, FULL_IMAGE, snapshot="''")
    text = (f"CASE seq % 29 WHEN 1 THEN '{{bad' WHEN 2 THEN '{{\"schema\":null}}' WHEN 3 THEN {no_table} "
            f"WHEN 4 THEN {other_op} WHEN 5 THEN {no_images} WHEN 6 THEN cast(null as string) "
            f"WHEN 7 THEN {empty_flag} WHEN 8 THEN '' WHEN 9 THEN '[1]' ELSE {full} END")
    return event_log(spark, sf_dir).selectExpr("seq", "event_ts", f"{text} AS value")


# --- typed inputs -----------------------------------------------------------------------------------

def customers_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base table with the columns of the event log: (id, event_type, value)."""
    return load(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS event_type", "c_acctbal AS value")


def suppliers_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `customers_as_rows`, with keys that cover only some of the log's."""
    return load(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS event_type", "s_acctbal AS value")


def lagging_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as seen by a target that has lost a third of them."""
    return load(spark, sf_dir, "orders").where("o_orderkey % 3 <> 1")


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as a target sees them: some rows lost, some left over under keys the source lacks."""
    orders = load(spark, sf_dir, "orders")
    extra = orders.where("o_orderkey % 13 = 0").withColumn("o_orderkey", F.expr("o_orderkey + 1000000000"))
    return orders.where("o_orderkey % 17 <> 0").unionByName(extra)


def lineitem_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    extra = lines.where("l_orderkey % 13 = 0").withColumn("l_suppkey", F.expr("l_suppkey + 1000000"))
    return lines.where("l_orderkey % 17 <> 0").unionByName(extra)


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SCHEMA = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                            T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
                            T.StructField("l_quantity", T.DoubleType())])


def line_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log keyed by four columns: every line is created; a third is deleted, a third gets one more piece."""
    key = ", ".join(f"'{k}', {k}" for k in LINE_KEYS)
    row = f"named_struct({key}, 'l_quantity', l_quantity + step)"
    none = "cast(null as struct<l_orderkey:bigint,l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,l_quantity:double>)"
    text = _envelope(f"if(op = 'd', {row}, {none})", f"if(op = 'd', {none}, {row})", table="'lineitem'", snapshot="'false'")
    steps = "explode(if(l_orderkey % 3 = 2, array(0), array(0, 1))) AS step"
    return (load(spark, sf_dir, "lineitem").selectExpr(*LINE_KEYS, "l_quantity", "l_extendedprice", steps)
            .withColumn("op", F.expr("CASE WHEN step = 0 THEN 'c' WHEN l_orderkey % 3 = 0 THEN 'd' ELSE 'u' END"))
            .selectExpr("step * 1000000000000L + cast(round(l_extendedprice * 100) as bigint) AS seq", f"{text} AS value"))


ORDER_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                             T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to orders: r, c, u or d by o_orderkey % 4; an update or create doubles the price."""
    row = ("named_struct('o_orderkey', o_orderkey, 'o_custkey', o_custkey, 'o_orderstatus', o_orderstatus, "
           "'o_totalprice', o_totalprice * 2)")
    none = "cast(null as struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>)"
    text = _envelope(f"if(op = 'd', {row}, {none})", f"if(op = 'd', {none}, {row})", table="'orders'", snapshot="'false'")
    return (load(spark, sf_dir, "orders")
            .withColumn("op", F.expr("element_at(array('r', 'c', 'u', 'd'), cast(o_orderkey % 4 as int) + 1)"))
            .selectExpr("o_orderkey AS seq", f"{text} AS value"))


def priority_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes, routed to one table per order status and priority; reads come from the snapshot."""
    row = "named_struct('o_orderkey', o_orderkey)"
    none = "cast(null as struct<o_orderkey:bigint>)"
    text = _envelope(f"if(op = 'd', {row}, {none})", f"if(op = 'd', {none}, {row})",
                     table="concat(o_orderstatus, ' ', o_orderpriority)", snapshot="if(op = 'r', 'true', 'false')")
    return (load(spark, sf_dir, "orders")
            .withColumn("op", F.expr("element_at(array('r', 'c', 'u', 'd'), cast(o_orderkey % 4 as int) + 1)"))
            .selectExpr("o_orderkey AS seq", f"{text} AS value"))


BAG_SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.IntegerType())])


def line_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and line number repeat: a table without a key."""
    return load(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS n")


def bag_envelopes(spark: SparkSession, sf_dir: str, op: str) -> DataFrame:
    """One event per order. Inserts add a line; updates move one line number to a new one; deletes name a
    line number, or for every fifth order leave it null, which matches all lines of the order."""
    none = "cast(null as struct<k:bigint,n:int>)"
    line = "cast(o_custkey % 7 + 1 as int)"
    images = {"c": (none, f"named_struct('k', o_orderkey, 'n', {line})"),
              "u": (f"named_struct('k', o_orderkey, 'n', {line})", f"named_struct('k', o_orderkey, 'n', {line} + 100)"),
              "d": (f"named_struct('k', o_orderkey, 'n', if(o_orderkey % 5 = 0, null, {line}))", none)}
    text = _envelope(*images[op], table="'lines'", op=f"'{op}'", snapshot="'false'")
    return load(spark, sf_dir, "orders").selectExpr("o_orderkey AS seq", f"{text} AS value")


STATE_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])


def chained_bag_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without a key whose updates build on one another: each moves a user's rows to the next state."""
    none = "cast(null as struct<user_id:bigint,event_type:string>)"
    row = "named_struct('user_id', user_id, 'event_type', event_type)"
    moved = "named_struct('user_id', user_id, 'event_type', element_at(array('view', 'click', 'purchase'), cast(event_id % 3 as int) + 1))"
    wide = "named_struct('user_id', user_id, 'event_type', cast(null as string))"
    text = _envelope(f"CASE op WHEN 'u' THEN {row} WHEN 'd' THEN {wide} ELSE {none} END",
                     f"CASE op WHEN 'u' THEN {moved} WHEN 'd' THEN {none} ELSE {row} END", table="'states'", snapshot="'false'")
    return (load(spark, sf_dir, "events")
            .withColumn("op", F.expr("CASE event_type WHEN 'error' THEN if(event_id % 10 = 0, 'd', 'c') WHEN 'signup' THEN 'c' ELSE 'u' END"))
            .selectExpr("event_id AS seq", f"{text} AS value"))


PARTIAL_STATE_SCHEMA = T.StructType([*STATE_SCHEMA.fields, T.StructField("value", T.DoubleType())])


def partial_bag_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without a key whose updates carry some columns. By `kind` they move rows of a state to the next one, set the
    value of such rows, set the value of all of a user's rows, or set state and value without naming the user."""
    none = "cast(null as map<string,string>)"
    user, state, value = "'user_id', cast(user_id as string)", "'event_type', event_type", "'value', cast(value as string)"
    moved = "'event_type', element_at(array('view', 'click', 'purchase'), cast(event_id % 3 as int) + 1)"
    before = f"CASE WHEN op = 'c' THEN {none} WHEN op = 'd' OR kind = 2 THEN map({user}) ELSE map({user}, {state}) END"
    after = (f"CASE WHEN op = 'd' THEN {none} WHEN op = 'c' THEN map({user}, {state}, {value}) WHEN kind = 0 THEN map({user}, {moved}) "
             f"WHEN kind = 3 THEN map({moved}, {value}) ELSE map({value}) END")
    text = _envelope(before, after, table="'states'", snapshot="'false'")
    return (load(spark, sf_dir, "events")
            .withColumn("op", F.expr("CASE event_type WHEN 'error' THEN if(event_id % 10 = 0, 'd', 'c') WHEN 'signup' THEN 'c' ELSE 'u' END"))
            .withColumn("kind", F.expr("CASE WHEN event_id % 16 = 2 THEN 2 WHEN event_id % 4 = 2 THEN 1 ELSE event_id % 4 END"))
            .selectExpr("event_id AS seq", f"{text} AS value"))


# --- decimals with a field schema ---------------------------------------------------------------------

CENTS = "if(o_orderkey % 2 = 0, 1, -1) * cast(round(o_totalprice * 100) as bigint)"
WIRE_CENTS = f"base64(unhex(lpad(hex({CENTS}), 16, if({CENTS} < 0, 'F', '0'))))"
SCALE = "cast(o_orderkey % 4 as string)"


def wide_decimals() -> list[tuple[str, str]]:
    """(wire value, plain text) of numbers with 20 to 65 digits and 7 decimal places, in both signs."""
    pairs = []
    for size in range(20, 66):
        digits = ("1234567890" * 7)[size % 9:][:size].lstrip("0").ljust(size, "7")
        for sign in ("", "-"):
            number = int(sign + digits)
            wire = number.to_bytes(number.bit_length() // 8 + 1, "big", signed=True)
            pairs.append((base64.b64encode(wire).decode(), f"{sign}{digits[:-7]}.{digits[-7:]}"))
    return pairs


def decimal_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with an embedded schema: price is a base64 decimal whose scale differs by row; code is
    text that happens to be valid base64 and must stay."""
    def field(name: str, logical: str, scale: str) -> str:
        return (f"named_struct('field', '{name}', 'name', {logical}, 'parameters', named_struct('scale', {scale}))")
    decimal = "'org.apache.kafka.connect.data.Decimal'"
    null = "cast(null as string)"
    fields = f"array({field('id', null, null)}, {field('price', decimal, SCALE)}, {field('code', null, null)})"
    schema = (f"named_struct('fields', array(named_struct('field', 'before', 'fields', {fields}), "
              f"named_struct('field', 'after', 'fields', {fields})))")
    after = f"named_struct('id', o_orderkey, 'price', {WIRE_CENTS}, 'code', 'AAAA')"
    payload = (f"named_struct('op', 'c', 'source', named_struct('table', 'orders', 'snapshot', 'false'), "
               f"'before', cast(null as struct<id:bigint>), 'after', {after})")
    text = f"to_json(named_struct('schema', {schema}, 'payload', {payload}), map('ignoreNullFields', 'false'))"
    return load(spark, sf_dir, "orders").selectExpr("o_orderkey AS seq", f"{text} AS value")


# --- catalogs ------------------------------------------------------------------------------------------

def part_catalog(spark: SparkSession, sf_dir: str, types: list[str]) -> DataFrame:
    """A source catalog with one column per part, 20 to a table, cycling through the given type names."""
    listed = ", ".join("'" + t.replace("'", "\\'") + "'" for t in types)
    return load(spark, sf_dir, "part").selectExpr(
        "concat('T', cast(p_partkey div 20 as string)) AS table",
        "concat('Col_', cast(p_partkey % 20 as string)) AS column",
        f"element_at(array({listed}), cast(p_partkey * 7 % {len(types)} as int) + 1) AS type_name",
        "cast(CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE p_size END as int) AS size",
        "cast(p_partkey % 4 as int) AS digits", "p_partkey % 3 <> 0 AS nullable",
        "p_partkey % 40 = 0 AS auto_increment", "cast(p_partkey % 20 + 1 as int) AS ordinal",
        "cast(if(p_partkey % 20 < 2, 2 - p_partkey % 20, null) as int) AS key_seq")


def part_target_catalog(source: DataFrame) -> DataFrame:
    """What the target has of it: every fifth table and some columns are missing, names are upper case."""
    number = F.expr("cast(substring(table, 2) as int)")
    column = F.expr("cast(substring(column, 5) as int)")
    return source.where((number % 5 != 0) & ((number + column) % 7 != 3)).withColumn("column", F.upper("column"))


def required_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured tables: those of the part catalog and one unknown table per supplier."""
    known = load(spark, sf_dir, "part").selectExpr("p_partkey div 20 AS position").distinct()
    unknown = load(spark, sf_dir, "supplier").selectExpr("1000000 + s_suppkey AS position")
    return known.unionByName(unknown).selectExpr("concat('T', cast(position as string)) AS table", "position")


# --- samples --------------------------------------------------------------------------------------------

def hourly_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, total, lag): running row totals of the source at every hour, and by how much the target's are lower.

    The target gets an event in the same hour or one or two hours later. The running sums see one row per
    hour, however many events there are.
    """
    from pyspark.sql import Window
    seen = load(spark, sf_dir, "events").select("event_id", F.expr("cast(timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts) as bigint)").alias("sample"))
    both = seen.select("sample", F.lit(1).alias("n"), F.lit(0).alias("arrived")).unionByName(
        seen.select((F.col("sample") + F.col("event_id") % 3).alias("sample"), F.lit(0).alias("n"), F.lit(1).alias("arrived")))
    hours = both.groupBy("sample").agg(F.sum("n").alias("n"), F.sum("arrived").alias("arrived"))
    window = Window.partitionBy(F.lit(1)).orderBy("sample").rowsBetween(Window.unboundedPreceding, 0)
    return hours.select("sample", F.sum("n").over(window).alias("total"), F.sum(F.col("n") - F.col("arrived")).over(window).alias("lag"))
