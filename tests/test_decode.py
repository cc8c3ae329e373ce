import base64
import json
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import decode as D
from tidemark.operators.reconcile import orphan_rows, remove_orphans
from tidemark.sources.changelog import decode_images, parse_changes, split_readable, unread_columns


def wire(n, extra=0):
    size = max(1, (n.bit_length() + 8) // 8) + extra
    return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()


def column(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_decimal_golden(spark):
    got = column(spark, ["A+c=", None, "A+c", "!!", "", "A +c="], lambda v: D.decode_decimal_text(v, F.lit("2")))
    assert got == ["9.99", None, "9.99", "!!", "", "A +c="]


def test_decimal_values(spark):
    rng = random.Random(1)
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 2**63 - 1, -2**63, 2**63, 2**64, -2**64, -2**64 - 1, 10**38 - 1, 1 - 10**38]
    numbers += [rng.randrange(-10**k, 10**k) for k in range(1, 38) for _ in range(3)]
    values = [wire(n, extra) for n in numbers for extra in (0, 1, 9)]
    want = [n for n in numbers for _ in range(3)]
    assert [int(x) for x in column(spark, values, lambda v: D.decode_decimal(v, 0, 38, 0))] == want
    assert column(spark, [wire(10**38), wire(-10**40), "@@"], lambda v: D.decode_decimal(v, 0, 38, 0)) == [None] * 3


def test_decimals_of_any_width(spark):
    rng = random.Random(7)
    numbers = [s * n for s in (1, -1) for n in (10**38, 10**38 - 1, 2**127, 2**128 - 1, 2**128, 2**160 + 1, 10**45, 10**63 + 9, 10**80)] + [-2**127 - 1, -2**127]
    numbers += [rng.randrange(-10**k, 10**k) for k in range(36, 120, 4) for _ in range(2)]
    values = [wire(n, extra) for n in numbers for extra in (0, 3)]
    assert column(spark, values, lambda v: D.decode_decimal_text(v, F.lit("0"))) == [str(n) for n in numbers for _ in range(2)]
    assert column(spark, [wire(n) for n in numbers], lambda v: D.decode_decimal_text(v, F.lit("40"))) == [
        ("-" if n < 0 else "") + str(abs(n)).rjust(41, "0")[:-40] + "." + str(abs(n)).rjust(41, "0")[-40:] for n in numbers]


def test_columns_match_whatever_their_case(spark):
    event = {"payload": {"op": "u", "source": {"table": "t"}, "before": {"ID": 1}, "after": {"Id": 1, "name": "old", "NAME": "new"}}}
    raw = spark.createDataFrame([(0, json.dumps(event))], "seq bigint, value string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("Name", T.StringType()), T.StructField("x", T.StringType())])
    row = decode_images(parse_changes(raw)[0], schema, keys=["id"]).first()
    assert (row.before.id, tuple(row.after), tuple(row.present)) == (1, (1, "new", None), (True, True, False))


@pytest.mark.parametrize("scale", [-2, 0, 1, 3, 20])
def test_decimal_scales(spark, scale):
    numbers = [0, 5, -5, 999, -1000, 123456789012345678901]
    got = column(spark, [wire(n) for n in numbers], lambda v: D.decode_decimal_text(v, F.lit(str(scale))))
    assert got == [format(Decimal(n).scaleb(-scale), "f") if n or scale > 0 else "0" for n in numbers]


def test_bad_scale_leaves_value(spark):
    assert column(spark, ["A+c="], lambda v: D.decode_decimal_text(v, F.lit("x"))) == ["A+c="]


def test_coercions(spark):
    assert column(spark, ["1", "0", "0.5", "-3.0", "true", "false", "word", None], D.to_boolean) == [
        True, False, False, True, True, False, None, None]
    assert column(spark, ["1700000000000", "2023-11-14T22:13:20+02:00", "2023-11-14T22:13:20.5", "2023-11-14", "x", None],
                  D.to_timestamp_ntz) == [datetime(2023, 11, 14, 22, 13, 20), datetime(2023, 11, 14, 20, 13, 20),
                                          datetime(2023, 11, 14, 22, 13, 20, 500000), None, None, None]
    assert column(spark, ["1700000000000", "2026-04-18T04:34:21Z", "2026-04-18T04:34:21"],
                  lambda v: F.unix_millis(D.to_timestamp_tz(v))) == [1700000000000, 1776486861000, None]
    assert column(spark, ["1700000000000000", "-1"], lambda v: D.to_timestamp_ntz(v, "us")) == [
        datetime(2023, 11, 14, 22, 13, 20), datetime(1969, 12, 31, 23, 59, 59, 999999)]
    assert column(spark, ["-1500"], lambda v: D.to_timestamp_ntz(v, "ns")) == [datetime(1969, 12, 31, 23, 59, 59, 999998)]
    assert column(spark, ["0", "-1", "2020-02-29", "nope", None], D.to_date) == [
        date(1970, 1, 1), date(1969, 12, 31), date(2020, 2, 29), None, None]
    assert column(spark, ["45296789", "0", "12:00", None], D.to_time_text) == ["12:34:56.789", "00:00:00.000", "12:00", None]
    with pytest.raises(ValueError):
        D.to_timestamp_ntz(F.col("v"), "days")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = column(spark, ["1700000000000", "2023-11-14T22:13:20Z", "2023-11-14T22:13:20"], lambda v: D.to_timestamp_ntz(v).cast("string"))
        assert got == ["2023-11-14 22:13:20"] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_images_are_decoded_by_their_own_schema(spark):
    fields = [{"field": "id", "name": None}, {"field": "price", "name": D.DECIMAL_LOGICAL_NAME, "parameters": {"scale": "2"}}]
    event = {"schema": {"fields": [{"field": "before", "fields": [fields[0]]}, {"field": "after", "fields": fields}]},
             "payload": {"op": "u", "source": {"table": "products"}, "before": {"id": 1, "price": "A+c="},
                         "after": {"id": 1, "price": "A+c=", "active": 1, "made": 1700000000000, "blob": "AQI=", "doc": {"a": [1, 2]}}}}
    bare = {"payload": {"op": "c", "source": {"table": "products"}, "after": {"id": 2, "price": 1.25, "active": False, "made": None}}}
    broken = {"payload": {"op": "c", "source": {"table": "products"}, "after": {"id": 3, "price": "A+c=", "active": "perhaps"}}}
    raw = spark.createDataFrame(list(enumerate(map(json.dumps, (event, bare, broken)))), "seq bigint, value string")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("price", T.DecimalType(10, 2)),
                           T.StructField("active", T.BooleanType()), T.StructField("made", T.TimestampNTZType()),
                           T.StructField("blob", T.BinaryType()), T.StructField("doc", T.StringType())])
    typed = decode_images(parse_changes(raw, field_schemas=True)[0], schema, keys=["id"])
    ok, failed = split_readable(typed, ["id"])
    rows = ok.orderBy("seq").select("after.*").collect()
    assert tuple(rows[0]) == (1, Decimal("9.99"), True, datetime(2023, 11, 14, 22, 13, 20), bytearray(b"\x01\x02"), '{"a":[1,2]}')
    assert tuple(rows[1]) == (2, Decimal("1.25"), False, None, None, None)
    assert failed.select("seq", unread_columns(failed, "after").alias("c")).collect() == [(2, ["price", "active"])]
    present = typed.orderBy("seq").select("present.*").collect()
    assert [tuple(p) for p in present][1] == (True, True, True, True, False, False)


def test_field_listed_twice_counts_as_listed_last(spark):
    twice = [{"field": "p", "name": None}, {"field": "p", "name": D.DECIMAL_LOGICAL_NAME, "parameters": {"scale": "1"}}]
    event = {"schema": {"fields": [{"field": "after", "fields": twice}]},
             "payload": {"op": "c", "source": {"table": "t"}, "after": {"p": "A+c="}}}
    raw = spark.createDataFrame([(0, json.dumps(event))], "seq bigint, value string")
    assert parse_changes(raw, field_schemas=True)[0].first().after == {"p": "99.9"}


def test_damaged_and_odd_lines(spark):
    lines = ["{bad", "{}", '{"payload":5}', "5", "", "  ", "null", None, '{"payload":null}', "[1]",
             '{"payload":{"op":"c","source":{"table":""}}}', '{"payload":{"op":"c","source":{"table":"t"},"after":5}}',
             '{"payload":{"op":7,"source":{"table":"t","snapshot":true},"after":{}}}']
    raw = spark.createDataFrame(list(enumerate(lines)), "seq bigint, value string")
    good, rejected = parse_changes(raw)
    assert [tuple(r) for r in rejected.collect()] == [(0, "{bad", "not_json")]
    assert [(r.seq, r.op, r.stage, r.action, r.applies) for r in good.orderBy("seq").collect()] == [
        (11, "c", "stream", "upsert", False), (12, "7", "snapshot", "ignore", False)]
    good, rejected = parse_changes(raw, order_field="pos")
    assert good.count() == 0 and rejected.where("reject_reason = 'no_position'").count() == 2


def test_key_types():
    assert D.normal_key_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert D.normal_key_type(T.IntegerType(), T.DecimalType(12, 0)) == T.LongType()
    assert D.normal_key_type(T.LongType(), T.DecimalType(20, 0)) == T.DecimalType(20, 0)
    assert D.normal_key_type(T.DecimalType(10, 1), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    assert D.normal_key_type(T.StringType(), T.StringType()) == T.StringType()
    assert D.normal_key_type(T.LongType(), T.StringType()) == T.StringType()
    assert D.normal_key_type(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert D.normal_key_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    for pair in ((T.DecimalType(38, 0), T.DecimalType(38, 10)), (T.LongType(), T.DoubleType()), (T.DateType(), T.StringType()), (T.BooleanType(), T.LongType())):
        with pytest.raises(ValueError):
            D.normal_key_type(*pair)


def test_decimal_keys_keep_their_fraction(spark):
    target = spark.createDataFrame([(Decimal("1.10"), 1), (Decimal("1.90"), 1)], "k decimal(10,2), n int")
    source = spark.createDataFrame([(Decimal("1.1"),)], "k decimal(10,1)")
    assert [r.k for r in orphan_rows(target, source, ["k"]).collect()] == [Decimal("1.90")]
    assert [r.k for r in remove_orphans(target, source, ["k"]).collect()] == [Decimal("1.10")]
