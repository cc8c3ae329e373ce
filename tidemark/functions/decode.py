"""Wire values to typed columns. All built-in expressions: no Python runs per row.

Every function takes the wire value as text, the way the parsed row images carry it, and gives
null where the value cannot be read; `decode_images` turns such nulls into rejected events.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: logical type name that marks a base64 decimal in the change log.
DECIMAL_LOGICAL_NAME = "org.apache.kafka.connect.data.Decimal"

WIDE = T.DecimalType(38, 0)

_INTEGER_TEXT = r"^[+-]?\d+$"
_OFFSET_TEXT = r"(Z|[+-]\d\d:?\d\d)$"
_DATE_TIME_TEXT = r"^\d{4,}-\d\d-\d\dT\d\d:\d\d"
_BASE64_TEXT = r"^[A-Za-z0-9+/]+={0,2}$"


def _widened(digits: Column, width: int) -> Column:
    """Hex digits of a two's-complement integer, sign-extended to a fixed width."""
    return F.lpad(digits, width, F.when(F.left(digits, F.lit(1)) >= "8", "F").otherwise("0"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, where the body mentions it in several branches."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unscaled_text(raw: Column) -> Column:
    """Bytes of a big-endian two's-complement integer of any width as decimal text; null when empty.

    `conv` reads eight bytes at a time instead of looping over bytes. Most values fit the first eight.
    """
    # Leading bytes that merely repeat the sign say nothing.
    return let(F.regexp_replace(F.hex(raw), "^(?:(?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", ""), _read_hex)


def _read_hex(digits: Column) -> Column:
    wide = _widened(digits, 32)
    # For negative values the borrow moves to the low half, so that no step needs more than 38 digits.
    negative = (F.left(digits, F.lit(1)) >= "8")
    high = F.conv(F.substring(wide, 1, 16), 16, -10).try_cast(WIDE) + negative.cast("int")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).try_cast(WIDE) - F.when(negative, F.lit(Decimal(2 ** 64))).otherwise(F.lit(Decimal(0)))
    both = F.try_add(F.try_multiply(high, F.lit(Decimal(2 ** 64))).try_cast(WIDE), low).try_cast(WIDE).cast("string")
    n = F.length(digits)
    # 128 bits reach a little beyond 38 digits; those values take the general way too.
    return (F.when(n.between(1, 16), F.conv(_widened(digits, 16), 16, -10))
            .when(n > 0, F.coalesce(F.when(n <= 32, both), _read_long_hex(digits, negative))))


def _read_long_hex(digits: Column, negative: Column) -> Column:
    """Any number of hex digits: 32 bits at a time, into base 10^9 digits with the lowest first."""
    base = F.lit(1_000_000_000).cast("bigint")
    whole = F.when(negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits)
    parts = F.ceil(F.length(digits) / 8).cast("int")
    padded = F.lpad(whole, parts * 8, F.lit("0"))

    def value(i: Column) -> Column:
        # The complement plus one, taken at the lowest part, is the magnitude of a negative number.
        read = F.conv(padded.substr(i * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
        return read + F.when(negative & (i == parts - 1), 1).otherwise(0)

    def shift(state: Column, part: Column) -> Column:
        done = F.struct(part.alias("carry"), F.expr("cast(array() AS array<bigint>)").alias("out"))

        def step(so_far: Column, digit: Column) -> Column:
            return let(digit * 4_294_967_296 + so_far["carry"], lambda v: F.struct(
                F.call_function("div", v, base).alias("carry"), F.concat(so_far["out"], F.array(v % base)).alias("out")))

        def finish(end: Column) -> Column:
            rest = F.array(end["carry"] % base, F.call_function("div", end["carry"], base))
            return F.when(end["carry"] == 0, end["out"]).otherwise(F.concat(end["out"], rest))

        return F.aggregate(state, done, step, finish)

    values = F.transform(F.sequence(F.lit(0), parts - 1), value)
    places = F.aggregate(values, F.expr("cast(array() AS array<bigint>)"), shift)
    text = F.ltrim(F.array_join(F.transform(F.reverse(places), lambda d: F.lpad(d.cast("string"), 9, "0")), ""), F.lit("0"))
    return F.concat(F.when(negative, "-").otherwise(""), F.when(text == "", "0").otherwise(text))


def _plain(unscaled: Column, scale: Column) -> Column:
    """Unscaled decimal text with the point put in; the scale may differ from row to row."""
    negative = unscaled.startswith("-")
    digits = F.when(negative, unscaled.substr(F.lit(2), F.length(unscaled))).otherwise(unscaled)
    padded = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
    pointed = let(padded, lambda p: F.concat(F.left(p, F.length(p) - scale), F.lit("."), F.right(p, scale)))
    zeros = F.when(unscaled == "0", "").otherwise(F.repeat(F.lit("0"), -scale))
    return F.when(scale > 0, F.concat(F.when(negative, "-").otherwise(""), pointed)).otherwise(F.concat(unscaled, zeros))


def decode_decimal_text(value: Column, scale: Column) -> Column:
    """Base64 decimal to plain text; null stays null and anything undecodable stays as it came."""
    places = F.coalesce(scale, F.lit("0")).try_cast("int")
    return F.coalesce(let(unscaled_text(_base64_bytes(value)), lambda u: _plain(u, places)), value)


def _base64_bytes(value: Column) -> Column:
    return F.when(value.rlike(_BASE64_TEXT), F.try_to_binary(value, F.lit("base64")))


def decode_decimal(value: Column, scale: Column | int, precision: int = 38, to_scale: int = 18) -> Column:
    """Base64 decimal to decimal(precision, to_scale); null when undecodable or out of range."""
    scale = F.lit(str(scale)) if isinstance(scale, int) else scale
    places = F.coalesce(scale, F.lit("0")).try_cast("int")
    scientific = F.concat(unscaled_text(_base64_bytes(value)), F.lit("E"), (-places).cast("string"))
    return scientific.try_cast(T.DecimalType(precision, to_scale))


def decode_record(image: Column, field_schemas: Column) -> Column:
    """Whole-image form: decode the fields whose schema says decimal, leave the others alone."""
    def one(name: Column, value: Column) -> Column:
        return let(F.try_element_at(field_schemas, name), lambda schema: F.when(
            schema["name"] == DECIMAL_LOGICAL_NAME, decode_decimal_text(value, schema["scale"])).otherwise(value))
    return F.transform_values(image, one)


def to_boolean(value: Column) -> Column:
    """Numbers are true unless their integer part is zero; true / false text passes."""
    number = value.try_cast("double").try_cast("bigint")
    return F.coalesce(number != 0, value.try_cast("boolean"))


def _epoch_micros(value: Column, unit: str) -> Column:
    number = F.when(value.rlike(_INTEGER_TEXT), value.try_cast("bigint"))
    if unit == "ms":
        return F.try_multiply(number, F.lit(1000))
    if unit == "us":
        return number
    if unit == "ns":
        return _div(number, 1000)
    raise ValueError(f"unknown time unit {unit!r}: use 'ms', 'us' or 'ns'")


def _div(value: Column, by: int) -> Column:
    """Integer division that rounds down."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def _ntz_of_micros(micros: Column) -> Column:
    """Microseconds since 1970 UTC as a zone-less timestamp, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def _instant_of_text(value: Column) -> Column:
    """ISO date-time text that carries an offset."""
    return F.when(value.rlike(_DATE_TIME_TEXT) & value.rlike(_OFFSET_TEXT), value.try_cast("timestamp"))


def to_timestamp_ntz(value: Column, unit: str = "ms") -> Column:
    """Epoch number, ISO text with offset (turned to UTC) or ISO local text."""
    local = F.when(value.rlike(_DATE_TIME_TEXT) & ~value.rlike(_OFFSET_TEXT), value.try_cast("timestamp_ntz"))
    return F.coalesce(_ntz_of_micros(_epoch_micros(value, unit)),
                      _ntz_of_micros(F.unix_micros(_instant_of_text(value))), local)


def to_timestamp_tz(value: Column, unit: str = "ms") -> Column:
    """Epoch number or ISO text; the text must carry an offset."""
    return F.coalesce(F.timestamp_micros(_epoch_micros(value, unit)), _instant_of_text(value))


def to_date(value: Column) -> Column:
    """Days since 1970, or ISO date text."""
    days = F.when(value.rlike(_INTEGER_TEXT), value.try_cast("int"))
    return F.coalesce(F.date_from_unix_date(days), F.when(~value.rlike(_INTEGER_TEXT), value.try_cast("date")))


def to_time_text(value: Column, unit: str = "ms") -> Column:
    """Time since midnight as HH:mm:ss.SSS; other text passes."""
    ms = F.pmod(_div(_epoch_micros(value, unit), 1000), F.lit(86_400_000))
    clock = F.format_string("%02d:%02d:%02d.%03d", _div(ms, 3_600_000),
                            F.pmod(_div(ms, 60_000), F.lit(60)), F.pmod(_div(ms, 1000), F.lit(60)),
                            F.pmod(ms, F.lit(1000)))
    return F.when(ms.isNotNull(), clock).otherwise(value)


def coerce(value: Column, target: T.DataType, unit: str = "ms", as_time: bool = False) -> Column:
    """Wire text to the type of the target column."""
    if as_time:
        return to_time_text(value, unit)
    if isinstance(target, T.BooleanType):
        return to_boolean(value)
    if isinstance(target, T.TimestampNTZType):
        return to_timestamp_ntz(value, unit)
    if isinstance(target, T.TimestampType):
        return to_timestamp_tz(value, unit)
    if isinstance(target, T.DateType):
        return to_date(value)
    if isinstance(target, T.BinaryType):
        return F.try_to_binary(value, F.lit("base64"))
    if isinstance(target, T.StringType):
        return value
    return value.try_cast(target)


def normal_key_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """Common type under which two key columns compare exactly.

    Integers widen to bigint; decimals keep their digits, so that 1.10 and 1.90 stay different keys. Dates
    meet timestamps at midnight. Pairs that no type holds exactly are refused: a key that cannot match would
    make every row an orphan.
    """
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if left == right and not isinstance(left, integral):
        return left
    sides = (left, right)
    if all(isinstance(t, integral) for t in sides):
        return T.LongType()
    if all(isinstance(t, integral + (T.DecimalType,)) for t in sides):
        decimals = [t for t in sides if isinstance(t, T.DecimalType)]
        if all(t.scale == 0 and t.precision <= 18 for t in decimals):
            return T.LongType()
        scale = max(t.scale for t in decimals)
        whole = max(19 if isinstance(t, integral) else t.precision - t.scale for t in sides)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if all(isinstance(t, (T.FloatType, T.DoubleType)) for t in sides):
        return T.DoubleType()
    small = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
    if all(isinstance(t, small) for t in sides):
        return T.DoubleType()  # holds every 32-bit integer
    if all(isinstance(t, (T.DateType, T.TimestampNTZType)) for t in sides):
        return T.TimestampNTZType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in sides):
        return T.TimestampType()
    text = (T.StringType, T.CharType, T.VarcharType)
    if all(isinstance(t, text) for t in sides):
        return T.StringType()
    if any(isinstance(t, text) for t in sides) and all(isinstance(t, integral + text) for t in sides):
        return T.StringType()
    raise ValueError(f"no exact common key type for {left} and {right}")
