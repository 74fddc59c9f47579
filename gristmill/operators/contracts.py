"""Guards on the shape and content of a frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    """Fail when columns are missing. Looks at the schema only; no job runs."""
    missing = sorted(set(needed).difference(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when the frame has no row. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def never_null(c: Column, name: str) -> Column:
    """The value itself; a null ends the job that computes it.

    The guard travels with the column, so checking costs no pass of its own over the input.
    """
    return F.coalesce(c, F.raise_error(F.lit(f"null {name}")))


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: the row count and the number of nulls in each named column, in one pass."""
    nulls = [F.count_if(F.col(name).isNull()).alias(f"null_{name}_count") for name in columns]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *nulls)
