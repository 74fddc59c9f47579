"""Column functions over ``array<float>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_norm(c: Column) -> Column:
    """Sum of squares in double precision."""
    return F.aggregate(c, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))


def l2_normalize(c: Column) -> Column:
    """Unit-length vector in float precision; a zero vector stays as it is.

    The norm rides along as a repeated array, so it is computed once per vector and not per element.
    """
    norm = F.sqrt(squared_norm(c)).cast("float")
    divisor = F.when(norm == 0, F.lit(1.0).cast("float")).otherwise(norm)
    return F.zip_with(c, F.array_repeat(divisor, F.size(c)), lambda x, n: (x / n).cast("float"))


def dimension(c: Column) -> Column:
    """Number of components; null for a null vector."""
    return F.when(c.isNotNull(), F.size(c))


def has_wrong_dimension(c: Column, dim: int) -> Column:
    """True where a vector is present and its length differs from ``dim``."""
    return c.isNotNull() & (F.size(c) != dim)


def vector_literal(c: Column, dim: int, strict: bool = True) -> Column:
    """Text form ``[x1,x2,...]``.

    A missing or wrongly sized vector fails the job when ``strict``, otherwise it becomes null so that the
    caller can set such rows aside.
    """
    valid = c.isNotNull() & (F.size(c) == dim)
    text = F.concat(F.lit("["), F.array_join(c.cast("array<double>").cast("array<string>"), ","), F.lit("]"))
    if not strict:
        return F.when(valid, text)
    found = F.coalesce(F.size(c).cast("string"), F.lit("null"))
    problem = F.concat(F.lit(f"vector dimension: expected {dim}, found "), found)
    return F.when(valid, text).otherwise(F.raise_error(problem))
