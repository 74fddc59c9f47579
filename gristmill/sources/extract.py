"""Readers for the operational sources: a relational table and a document collection."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FETCH_SIZE = 5000


def relational_options(
    url: str,
    table: str,
    fetch_size: int = FETCH_SIZE,
    split: tuple[str, int | str, int | str, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """JDBC options for a whole-table read.

    ``split`` is ``(column, lower, upper, partitions)`` over a numeric, date or timestamp column and lets the
    partitions read their ranges in parallel; without it one task reads the table through a cursor.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if split:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def literal(value: Any) -> str:
    """A value as standard SQL text, for predicates that a database evaluates."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")


def equal_depth_splits(keys: DataFrame, splits: int, then: str | None = None, hot_share: float = 2.0) -> list[str]:
    """Predicates that cut a source into about equally many rows each; every row meets exactly one, null keys included.

    ``keys`` has the key as its first column: read that column alone from the source, or a sample of its rows. Ranges of equal width put
    a crowded stretch of keys into one connection; here the bounds are those of a range partitioning of the keys, which Spark
    draws from a sample. A key that alone holds more than ``hot_share`` splits' worth of rows is cut by a second column,
    ``then``, if there is one. The splits come in the order of the key, its nulls last.
    """
    key = keys.columns[0]
    known = keys.where(F.col(key).isNotNull())
    dealt = known.repartitionByRange(splits, key).groupBy(F.spark_partition_id().alias("part"))
    # Times in the session's zone, not in the driver's.
    shown = "timestamp_ntz" if isinstance(keys.schema[key].dataType, T.TimestampType) else keys.schema[key].dataType
    ends = [f(key).cast(shown).alias(end) for f, end in ((F.min, "low"), (F.max, "high"))]
    rows = dealt.agg(*ends, F.count(F.lit(1)).alias("n")).orderBy("low").collect()
    total, name = sum(r["n"] for r in rows), _quoted(key)
    bounds = [r["low"] for r in rows]
    out: list[str] = []
    for row, low, high in zip(rows, [None, *bounds[1:]], [*bounds[1:], None]):
        limits = [f"{name} {sign} {literal(bound)}" for sign, bound in ((">=", low), ("<", high)) if bound is not None]
        hot = then and row["low"] == row["high"] and row["n"] > hot_share * total / splits
        if not hot:
            out.append(" AND ".join(limits) or f"{name} IS NOT NULL")
            continue
        # One value fills the split, which may still be open below or above: those rows are a split of their own.
        value = f"{name} = {literal(row['low'])}"
        rest = keys.where(F.col(key) == F.lit(row["low"])).select(then)
        out += [f"{value} AND ({inner})" for inner in equal_depth_splits(rest, max(2, round(row["n"] * splits / total)))]
        out.append(" AND ".join([*limits, f"{name} <> {literal(row['low'])}"]))
    return [*out, f"{name} IS NULL"]


def _quoted(name: str) -> str:
    return name if name.isidentifier() else '"' + name.replace('"', '""') + '"'


def read_relational(spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None = None, **how) -> DataFrame:
    """A relational table, in one partition per predicate if there are any; see :func:`equal_depth_splits`."""
    options = relational_options(url, table, **how)
    if not predicates:
        return spark.read.format("jdbc").options(**options).load()
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


def read_documents(spark: SparkSession, source_format: str, options: Mapping[str, str], schema=None) -> DataFrame:
    """A document collection through whatever connector format is installed."""
    reader = spark.read.format(source_format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()
