"""One row per key, chosen by a total order so that reruns give the same rows.

All variants rank with ``row_number`` and keep rank 1. Spark pushes that limit below the shuffle
(WindowGroupLimit), so a key that holds a large share of the table sends one row per map task instead of
all its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.operators.contracts import require_columns

_RANK = "_rank_in_key"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).where(F.col(_RANK) == 1).drop(_RANK)


def newest(*columns: str) -> list[Column]:
    """Descending order with nulls last."""
    return [F.col(name).desc_nulls_last() for name in columns]


def tie_break(df: DataFrame, decided: Iterable[str]) -> list[Column]:
    """Order over every column not decided yet; rows that still tie are equal."""
    skip = set(decided)
    return [_sortable(field).desc_nulls_last() for field in df.schema if field.name not in skip]


def digest_order(df: DataFrame, decided: Iterable[str]) -> list[Column]:
    """An order like :func:`tie_break` that compares 64 bits of the columns not decided yet instead of the columns.

    For rows with long texts and maps: the sort before and after the shuffle then has numbers for keys only. Only rows of one key
    are compared, so one digest tells them apart; a second one would be as many bytes that do not compress.
    """
    skip = set(decided)
    rest = [_sortable(field) for field in df.schema if field.name not in skip]
    return [F.xxhash64(*rest).desc()]


def _sortable(field: T.StructField) -> Column:
    c = F.col(field.name)
    return F.sort_array(F.map_entries(c)) if isinstance(field.dataType, T.MapType) else c


def latest_by(df: DataFrame, keys: Sequence[str], *order_columns: str) -> DataFrame:
    """The newest row of each key by one or more columns, nulls last."""
    require_columns(df, [*keys, *order_columns])
    order = newest(*order_columns) + tie_break(df, [*keys, *order_columns])
    return first_per_key(df, keys, order)


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with no preferred row; the largest in column order is taken."""
    return latest_by(df, keys)


def dedup_by_key(df: DataFrame, key: str, order_column: str = "updated_at") -> DataFrame:
    """Latest row per key when the order column exists, otherwise any one row per key."""
    require_columns(df, [key])
    return latest_by(df, [key], *([order_column] if order_column in df.columns else []))


def longest_by(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """The row with the longest text of each key; equal lengths fall back to the text itself."""
    order = [F.length(text).desc_nulls_last()] + newest(text) + tie_break(df, [*keys, text])
    return first_per_key(df, keys, order)
