"""Parsing of loosely typed source fields. Bad input yields null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source formats.
PRICE_PATTERN = r"(\d+(?:\.\d+)?)"
WHOLE_NUMBER_PATTERN = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
REVIEW_DATE_PATTERN = r"^\s*(\d{1,2} \d{1,2}, \d{4})"
REVIEW_DATE_FORMAT = "M d, yyyy"
KEY_SEPARATOR = "||"


def parse_price(c: Column) -> Column:
    """First plain decimal number in the text. A thousands comma ends the number."""
    return F.regexp_extract(c.cast("string"), PRICE_PATTERN, 1).try_cast("double")


def parse_vote(c: Column) -> Column:
    """Vote count with optional thousands commas; a fraction is cut off."""
    digits = F.regexp_extract(F.replace(c.cast("string"), F.lit(","), F.lit("")), WHOLE_NUMBER_PATTERN, 1)
    return digits.try_cast("int")


def parse_review_date(c: Column) -> Column:
    """Month day, year with one or two digits each; text after the year is ignored."""
    return F.try_to_date(F.regexp_extract(c, REVIEW_DATE_PATTERN, 1), REVIEW_DATE_FORMAT)


def parse_timestamp(c: Column) -> Column:
    """ISO-like text to a timestamp in the session zone."""
    return F.try_to_timestamp(c.cast("string"))


def epoch_to_timestamp(c: Column) -> Column:
    """Whole seconds since 1970 to a timestamp."""
    return F.timestamp_seconds(c.try_cast("bigint"))


def parse_flag(c: Column) -> Column:
    """Boolean that stays null when missing or unreadable."""
    return c.try_cast("boolean")


def review_key_text(asin: Column, reviewer: Column, unix_time: Column, rating: Column) -> Column:
    """The four parts that make a review, joined; a missing part counts as empty text."""
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (asin, reviewer, unix_time, rating)]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def review_key(asin: Column, reviewer: Column, unix_time: Column, rating: Column) -> Column:
    """Technical review id: digest over four parts, a missing part counting as empty text."""
    return F.sha2(review_key_text(asin, reviewer, unix_time, rating), 256)


def packed(c: Column) -> Column:
    """A text as bytes that differ where texts do: a digest of 64 hexadecimal digits in half its length, any other text as it is.

    The first byte says which. Rows in a shuffle are compressed without an alphabet of their own, so digests cost what they are long.
    """
    digest = F.concat(F.lit(b"\x00"), F.unhex(c))
    return F.when(c.rlike("^[0-9a-f]{64}$"), digest).otherwise(F.concat(F.lit(b"\x01"), c.cast("binary")))


def unpacked(c: Column) -> Column:
    """The text of :func:`packed` bytes."""
    rest = F.substring(c, 2, 2**31 - 1)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x00"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def string_array(c: Column, data_type: T.DataType) -> Column:
    """Array of strings from an array of anything or from a scalar.

    A null array becomes empty; a scalar is wrapped as it is, so a null scalar gives ``[null]``.
    """
    if not isinstance(data_type, T.ArrayType):
        return F.array(c.cast("string"))
    return F.coalesce(c.cast("array<string>"), F.array().cast("array<string>"))


def array_text_length(c: Column, data_type: T.DataType) -> Column:
    """Summed length of all texts in an array; null and non-array columns count as 0.

    Joining without a separator skips null elements and keeps the expression in generated code.
    """
    if not isinstance(data_type, T.ArrayType):
        return F.lit(0)
    return F.coalesce(F.length(F.array_join(c.cast("array<string>"), "")), F.lit(0))


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def string_map(c: Column, data_type: T.DataType) -> Column:
    """Map of strings from a struct or a map; null fields drop out and a null input gives an empty map."""
    if isinstance(data_type, T.StructType):
        pairs = []
        for field in data_type.fields:
            value = c.getField(field.name)
            nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
            pairs += [F.lit(field.name), F.to_json(value) if nested else value.cast("string")]
        as_map = F.create_map(*pairs) if pairs else empty_map()
    elif isinstance(data_type, T.MapType):
        as_map = c.cast("map<string,string>")
    else:
        as_map = F.from_json(c.cast("string"), "map<string,string>")
    kept = F.map_filter(as_map, lambda _, value: value.isNotNull())
    return F.when(c.isNotNull(), F.coalesce(kept, empty_map())).otherwise(empty_map())


def map_text(c: Column) -> Column:
    """Readable, order-independent form of a string map: ``k=v`` pairs sorted and comma-joined."""
    pairs = F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.sort_array(pairs), ",")


def json_string_array(c: Column) -> Column:
    """Array of strings from JSON text holding an array or a single value."""
    text = F.ltrim(c)
    return F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")).when(
        c.isNotNull(), F.array(c)
    )
