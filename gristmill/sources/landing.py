"""Line-oriented landing tables: one JSON document per line, some of them broken."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.parse import json_string_array
from gristmill.operators.dedup import longest_by

# Document field -> table column.
PRODUCT_TEXT_FIELDS = {
    "asin": "asin",
    "title": "title",
    "brand": "brand",
    "main_cat": "main_cat",
    "similar_item": "similar_item",
    "tech1": "tech1",
    "tech2": "tech2",
    "fit": "fit",
    "date": "date_raw",
    "price": "price_raw",
}
PRODUCT_ARRAY_FIELDS = {
    "category": "category",
    "description": "description",
    "feature": "feature",
    "rank": "rank",
    "also_buy": "also_buy",
    "also_view": "also_view",
    "imageURL": "image_url",
    "imageURLHighRes": "image_url_high_res",
}

_STRICT_JSON = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def parse_objects(line: Column, fields: Mapping[str, str]) -> Column:
    """The JSON objects on a line as an array of structs of the given fields and types.

    A line is good when the array has exactly one element: reading the line as the inside of an array makes any
    text after an object an error, which gives null.
    """
    element = ", ".join(f"`{name}`: {kind}" for name, kind in fields.items())
    text = F.trim(line)
    framed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<struct<{element}>>", _STRICT_JSON)
    is_object = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    return F.when(is_object, framed)


def valid_documents(lines: DataFrame, fields: Mapping[str, str], key: str) -> DataFrame:
    """``line, doc`` of the lines that hold one valid object with a non-empty key."""
    parsed = lines.select("line", parse_objects(F.col("line"), fields).alias("docs"))
    unpacked = parsed.select("line", "docs", F.explode_outer("docs").alias("doc"))
    # One condition over both columns: a filter on either alone would move below and parse the line again.
    found = F.when(F.size("docs") == 1, F.col(f"doc.{key}"))
    return unpacked.where(F.coalesce(found, F.lit("")) != "").select("line", "doc")


def product_documents(lines: DataFrame) -> DataFrame:
    """One product document per key, the longest line winning, projected to the table's columns.

    Only the key is read before the choice, so the shuffle moves the lines and not their parsed form.
    """
    fields = dict.fromkeys([*PRODUCT_TEXT_FIELDS, *PRODUCT_ARRAY_FIELDS], "string")
    keyed = valid_documents(lines, {"asin": "string"}, "asin").select("line", F.col("doc.asin").alias("asin"))
    chosen = longest_by(keyed, ["asin"], "line")
    parsed = chosen.select(F.get(parse_objects(F.col("line"), fields), F.lit(0)).alias("doc"))
    texts = [F.col(f"doc.{old}").alias(new) for old, new in PRODUCT_TEXT_FIELDS.items()]
    arrays = [json_string_array(F.col(f"doc.{old}")).alias(new) for old, new in PRODUCT_ARRAY_FIELDS.items()]
    return parsed.select(*texts, *arrays)
