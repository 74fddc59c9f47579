"""Checks on finished data products: feature tables and the vector table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.vectors import dimension, has_wrong_dimension
from gristmill.operators.quality import same_value

VECTOR_KEY = "review_id"
VECTOR_REQUIRED = ("review_id", "embedding", "model_version", "text_hash")
VECTOR_PREVIEW = ("review_id", "asin", "model_version", "text_hash", "created_at")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def vector_counts(vectors: DataFrame) -> DataFrame:
    return vectors.agg(
        F.count(F.lit(1)).alias("embeddings_count"),
        F.countDistinct("review_id").alias("distinct_reviews"),
        F.countDistinct("asin").alias("distinct_products"),
        F.countDistinct("model_version").alias("model_versions"),
    )


def dimension_histogram(vectors: DataFrame) -> DataFrame:
    grouped = vectors.groupBy(dimension(F.col("embedding")).alias("embedding_dimension"))
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


def vector_preview(vectors: DataFrame, n: int = 10) -> DataFrame:
    """The first rows by id, metadata only."""
    return vectors.select(*VECTOR_PREVIEW).orderBy(VECTOR_KEY).limit(n)


def vector_checks(
    vectors: DataFrame,
    dim: int,
    key: str = VECTOR_KEY,
    required: Sequence[str] = VECTOR_REQUIRED,
) -> DataFrame:
    """Four checks, one row each.

    Everything is counted in one aggregation by key followed by a small global one: the per-key step is
    partial before the shuffle and moves counters and digests of keys only, never vectors.
    """
    any_null = reduce(Column.__or__, [F.col(name).isNull() for name in required])
    wrong = has_wrong_dimension(F.col("embedding"), dim)
    per_key = vectors.groupBy(*same_value(F.col(key), vectors.schema[key].dataType)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(any_null).alias("nulls"),
        F.count_if(wrong).alias("wrong"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong"),
    )

    def check(name: str, metric: str, condition: str, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.col(metric).alias("metric_value"),
            F.lit(condition).alias("expected_condition"),
            passed.alias("passed"),
        )

    # The names and conditions of the report.
    rows = F.array(
        check("table_not_empty", "n", "count > 0", F.col("n") > 0),
        check("no_nulls_in_required_columns", "nulls", "count = 0", F.col("nulls") == 0),
        check("no_duplicate_review_id", "repeated", "count = 0", F.col("repeated") == 0),
        check(
            "all_embeddings_have_expected_dimension",
            "wrong",
            f"count = 0 for vector_dims(embedding) != {dim}",
            F.col("wrong") == 0,
        ),
    )
    return totals.select(F.inline(rows))


def vector_report(vectors: DataFrame, dim: int, table_name: str, executed_at: str) -> DataFrame:
    """One report document with the overall status and the four checks."""
    results = vector_checks(vectors, dim)
    folded = results.agg(
        F.when(F.every("passed"), F.lit("success")).otherwise(F.lit("failed")).alias("overall_status"),
        F.collect_list(F.struct(*results.columns)).alias("checks"),
    )
    return folded.select(
        F.lit(executed_at).alias("execution_timestamp_utc"),
        F.lit(table_name).alias("table_name"),
        F.lit(dim).alias("expected_vector_dimension"),
        "overall_status",
        "checks",
    )
