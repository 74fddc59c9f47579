"""Profiling aggregates over reviews and loaded tables; each is one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import text_length


#: A plain decimal number; casts alone would also take NaN, infinities and type suffixes such as 5d.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def numeric_only(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose value is a finite plain number, as a double."""
    plain = F.rlike(F.col(column).cast("string"), F.lit(_NUMBER))
    as_number = F.when(plain, F.col(column).try_cast("double"))
    return df.withColumn(column, as_number).where(F.col(column).isNotNull() & (F.abs(column) < float("inf")))


def rating_stats(df: DataFrame, column: str) -> DataFrame:
    rated = numeric_only(df.select(column), column)
    return rated.agg(
        F.avg(column).alias("avg_rating"),
        F.min(column).alias("min_rating"),
        F.max(column).alias("max_rating"),
        F.count(F.lit(1)).alias("total_reviews"),
    )


def rating_distribution(df: DataFrame, column: str) -> DataFrame:
    rated = numeric_only(df.select(column), column)
    counts = rated.groupBy(F.col(column).alias("rating")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("rating"))


def text_length_profile(df: DataFrame, column: str) -> DataFrame:
    length = text_length(F.col(column))
    return df.agg(F.avg(length).alias("avg_length"), F.max(length).alias("max_length"))


def window_start(now: Column, days: int = 365) -> Column:
    """Epoch second that many days before a timestamp."""
    return F.unix_seconds(now) - F.lit(days * 86400)


def freshness(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    """Newest and oldest event of a column of epoch seconds, and the rows not older than the cutoff."""
    seconds = F.col(column).try_cast("bigint")
    return df.agg(
        F.timestamp_seconds(F.max(seconds)).alias("newest"),
        F.timestamp_seconds(F.min(seconds)).alias("oldest"),
        F.count_if(seconds >= cutoff).alias("reviews_in_last_year"),
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(key).alias("distinct_keys"))


def stats_document(df: DataFrame, column: str, now: Column, doc_id: str = "global_stats") -> DataFrame:
    """The summary document kept under one id: average, count and time of the update."""
    stats = rating_stats(df, column)
    return stats.select(
        F.lit(doc_id).alias("_id"),
        "avg_rating",
        "total_reviews",
        F.unix_seconds(now).cast(T.LongType()).alias("last_updated"),
    )
