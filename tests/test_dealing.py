"""Rows dealt by cost, splits of a source by its keys, and orders over long rows."""

import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import dealing, dedup
from gristmill.plans import staging, vectors
from gristmill.sources import extract, samples


def shares(df, cost):
    return sorted(r["c"] for r in df.groupBy(F.spark_partition_id()).agg(F.sum(cost).alias("c")).collect())


def test_few_long_texts_are_spread(spark, tmp_path):
    rows = [(i, "x" * 90_000) for i in range(10)] + [(100 + i, "y" * 100) for i in range(1000)]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert df.rdd.getNumPartitions() == 1
    dealt = dealing.deal_by_cost(df, F.length("text"), tasks=10)
    costs = shares(dealt, F.length("text"))
    assert len(costs) == 10 and costs[-1] <= 1.5 * costs[len(costs) // 2]
    assert sorted(map(tuple, dealt.collect())) == sorted(rows)
    assert dealt.schema == df.schema


def test_dealing_of_odd_frames(spark):
    df = spark.createDataFrame([(1, None, [1]), (2, "a", None), (None, "b" * 50, [])], "id int, text string, xs array<int>")
    dealt = dealing.deal_by_cost(df.withColumn("m", F.create_map(F.lit("k"), "text")), F.length("text"), tasks=3)
    assert sorted(map(str, dealt.drop("m").collect())) == sorted(map(str, df.collect()))
    assert dealing.deal_by_cost(df.limit(0), F.length("text")).count() == 0
    free = dealing.deal_by_cost(spark.range(100).repartition(4), F.lit(0), tasks=5)
    assert shares(free, F.lit(1)) == [20] * 5


def test_cost_decides_the_number_of_tasks(spark):
    df = spark.range(1000).withColumn("c", F.lit(1000))
    assert dealing.deal_by_cost(df, F.col("c"), per_task=10_000).rdd.getNumPartitions() == 100
    assert dealing.deal_by_cost(df, F.col("c")).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_inference_reads_dealt_rows(spark, sf_dir):
    from gristmill.operators.embedding import hashed_tokens
    from gristmill.registry import _document_reviews

    prepared = vectors.prepare(_document_reviews(spark, sf_dir.replace("sf0.01", "sf0.001")), "v")
    plan = vectors.embed_reviews(prepared, hashed_tokens(4))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Exchange") < plan.index("MapInArrow")


def test_reviews_are_sorted_by_numbers_only(spark, sf_dir):
    staged = staging.reviews(samples.raw_reviews(spark, sf_dir.replace("sf0.01", "sf0.001")), "2024-01-01")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if " Sort [" in line]
    assert keys and not any(name in line for line in keys for name in ("review_text#", "summary#", "style#"))


def test_digest_order_is_total_and_repeatable(spark):
    rows = [("k", i % 3, f"text {i % 5}", {"a": str(i % 2), "b": "x"}) for i in range(60)] + [("k", 2, None, None)]
    df = spark.createDataFrame(rows, "key string, votes int, text string, style map<string,string>")
    won = set()
    for parts in (1, 3, 7):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        order = dedup.newest("votes") + dedup.digest_order(shuffled, ["key", "votes"])
        won.add(str(dedup.first_per_key(shuffled, ["key"], order).collect()))
    assert len(won) == 1


def met(df, predicates):
    return [df.where(F.expr(p)).count() for p in predicates]


def assert_partition(df, predicates):
    counts = met(df, predicates)
    assert sum(counts) == df.count()
    once = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    assert df.where(sum(once[1:], once[0]) != 1).isEmpty()
    return counts


@pytest.mark.parametrize("kind", ["id", "CAST(id AS string)", "DATE'2024-01-01' + CAST(id % 5000 AS int)", "timestamp_seconds(id * 7)", "CAST(id AS decimal(20,3))", "id / 3"])
def test_splits_are_of_equal_depth(spark, tmp_path, kind):
    # Most keys lie in a short stretch at the end of the range.
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, id, 1000000 + id DIV 2) AS id").selectExpr(f"{kind} AS key", "id AS second")
    df = df.unionByName(spark.range(37).selectExpr(f"CAST(NULL AS {df.schema['key'].dataType.simpleString()}) AS key", "id AS second"))
    df.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    predicates = extract.equal_depth_splits(df.select("key"), 8)
    counts = assert_partition(df, predicates)
    assert len(predicates) == 9 and counts[-1] == 37 and max(counts) < 2 * 20_000 / 8


def test_a_hot_key_is_cut_by_the_second_column(spark, tmp_path):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', CONCAT('k', id % 997)) AS key", "id AS second")
    df.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plain = assert_partition(df, extract.equal_depth_splits(df.select("key"), 10))
    assert max(plain) >= 10_000
    cut = assert_partition(df, extract.equal_depth_splits(df.select("key", "second"), 10, then="second"))
    assert max(cut) < 2.5 * 3000


def test_splits_of_few_or_no_keys(spark):
    for values in ([], [None], ["a'b"], ["a'b", "a'b", None], [None, "x", "y"]):
        df = spark.createDataFrame([(v,) for v in values], "`odd key` string")
        predicates = [p.replace('"odd key"', "`odd key`").replace("'a''b'", '"a\'b"') for p in extract.equal_depth_splits(df, 4)]
        assert_partition(df, predicates)
    assert extract.literal("it's") == "'it''s'" and extract.literal(True) == "TRUE"
    with pytest.raises(TypeError):
        extract.literal([1])
