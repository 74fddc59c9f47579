"""Shapes of physical plans that matter on large data."""

import re
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill import registry, session
from gristmill.operators import quality
from gristmill.plans import features, staging, suites, vectors
from gristmill.sources import samples
from gristmill.streaming import cursor


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return [set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[(.*?)\]", plan)]


@pytest.fixture(scope="module")
def stored_reviews(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("staging") / "reviews")
    small = sf_dir.replace("sf0.01", "sf0.001")
    staging.reviews(samples.raw_reviews(spark, small), "2024-01-01").write.parquet(path)
    return spark.read.parquet(path)


def test_features_read_only_their_columns(stored_reviews):
    (columns,) = read_columns(plan_of(features.user_features(stored_reviews, "2024-01-02")))
    assert columns == {"reviewer_id", "asin", "rating", "verified", "vote_count", "review_timestamp", "review_text"}
    facts = features.review_facts(stored_reviews)
    assert features.review_facts(facts).columns == features.REVIEW_FACTS


def test_distinct_counts_spread_a_hot_reviewer(stored_reviews):
    plan = plan_of(features.user_features(stored_reviews, "2024-01-02"))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert [len(k.split(", ")) for k in keys] == [1, 2]


def test_reviews_are_shuffled_once_per_join(spark, stored_reviews):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = features.review_facts(stored_reviews)
        # Stand-ins with the columns of the feature tables; only the joins are of interest here.
        items = facts.select("asin", *[F.lit(1).alias(c) for c in ("main_category", "brand", "price", "title_length")])
        items = items.withColumn("description_total_length", F.lit(0))
        users = facts.select("reviewer_id", *[F.lit(1).alias(c) for c in features.USER_COLUMNS.values()])
        stats = facts.select("asin", *[F.lit(1).alias(c) for c in features.STATS_COLUMNS.values()])
        table = features.user_product_interactions(facts, items, users, stats, "2024-01-02", reviews_are_unique=True)
        plan = plan_of(table)
        # Reviews and reviewers, then reviews and the product profile, whose two parts are shuffled for it.
        assert len(re.findall(r"Exchange hashpartitioning\(reviewer_id", plan)) == 2
        assert len(re.findall(r"Exchange hashpartitioning\(asin", plan)) == 4
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_cross_to_python_once_and_are_cleaned_once(stored_reviews):
    plan = plan_of(vectors.prepare(stored_reviews, "m"))
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("regexp_replace") == 2
    assert "BatchEvalPython" not in plan


def test_cursor_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(cursor.after(samples.table(spark, sf_dir, "events"), "event_id", "100"))
    assert "GreaterThan(event_id,100)" in plan


def test_uniqueness_reads_the_key_only(stored_reviews):
    schemas = read_columns(plan_of(quality.evaluate(stored_reviews, suites.STAGING_REVIEWS)))
    assert {"review_id"} in schemas and len(schemas) == 2
    assert not any("review_text" in s for s in schemas)


def test_shared_folder_is_needed_on_a_cluster():
    context = SimpleNamespace(master="yarn")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(unset)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: "hdfs:///shared/"), sparkContext=context)
    assert session.shared_dir(named) == "hdfs:///shared"


def test_ids_are_digested_after_the_shuffle_and_facts_are_those_of_staging(spark):
    rows = [
        ("A1", "U1", "10", 4.0, "3", "long text", True), ("A1", "U1", "10", 4.0, "5", "text", None), ("A1", "U1", "10", 2.0, None, None, False),
        (None, None, None, None, None, " ", None), (None, None, None, None, "1", "x", None), ("A1", "U1", "x", -0.0, None, "y", True),
        ("A1", "U1", "x", 0.0, None, "z", True),
    ]
    raw = spark.createDataFrame(rows, "asin string, reviewerID string, unixReviewTime string, overall double, vote string, reviewText string, verified boolean")
    raw = raw.selectExpr("*", "'1' AS _id", "'1 2, 2020' AS reviewTime", "reviewText AS summary")
    staged, facts = staging.reviews(raw, "2024-01-01"), staging.review_facts(raw, "2024-01-01")
    assert staged.count() == 5
    for df in (staged, features.with_review_id(facts)):
        above, below = plan_of(df).split("Exchange hashpartitioning(_review_key", 1)
        assert "sha2(" in above and "sha2(" not in below
    assert sorted(map(str, features.with_review_id(facts).select(*features.REVIEW_FACTS).collect())) == sorted(
        map(str, features.review_facts(staged).collect())
    )
    users = [features.product_review_stats(df, "2024-01-02").collect() for df in (staged, facts)]
    assert sorted(map(str, users[0])) == sorted(map(str, users[1]))
    base = features.user_features(facts, "2024-01-02"), features.product_review_stats(facts, "2024-01-02")
    products = spark.createDataFrame([], "asin string, title string, brand string, price double, title_length int, description_total_length int, main_category string")
    twice = [features.user_product_interactions(df.unionByName(df), products, *base, "2024-01-02").collect() for df in (staged, facts)]
    assert sorted(map(str, twice[0])) == sorted(map(str, twice[1])) and len(twice[0]) == 5


def test_uniqueness_of_long_texts_keeps_no_text(spark):
    df = spark.createDataFrame([("a" * 1000,), ("a" * 1000,), ("b",), (None,), (None,)], "c string")
    found = quality.evaluate(df, [quality.unique("c")])
    assert [(r["element_count"], r["missing_count"], r["unexpected_count"]) for r in found.collect()] == [(5, 2, 2)]
    assert "hashpartitioning(c#" not in plan_of(found) and "xxhash64(c" in plan_of(found)


def test_products_are_dealt_before_they_are_sorted(spark, sf_dir):
    plan = plan_of(staging.products(samples.raw_products(spark, sf_dir), "2024-01-01"))
    # Read from below: the records are dealt, then limited, then meet by their key.
    assert re.search(r"hashpartitioning\(asin#.*WindowGroupLimit.*hashpartitioning\(xxhash64\(asin", plan, re.S)


def test_named_queries_bound_what_the_planner_merges(spark, sf_dir):
    """Partitions of narrow rows become thirty times their size behind a join, so they are not merged up to 64 MB."""
    registry.queries()["staging_reviews"](spark, sf_dir)
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 16 << 20


def test_boundary_set_parses_a_line_once_to_test_it(spark):
    stored = ['{"at":3}', '{"at":5,"x":1}', '{"at":null}', '{"x":"at"}', '{"at":9}']
    lines = spark.createDataFrame([(v,) for v in stored], "value string")
    found = cursor.boundary(lines, "at", "5", T.LongType())
    assert sorted(r["cursor"] or "" for r in found.collect()) == ["", "", "5", "9"]
    assert [r["cursor"] for r in cursor.boundary(lines, "at", None, T.LongType()).collect()] == [None, None]
    assert len(cursor.boundary(lines, "at", "5", T.LongType(), 2).collect()) == 5
    (kept,) = re.findall(r"Filter .*", plan_of(found))
    assert kept.count("get_json_object") == 1


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.mkString(" ")))


def test_shuffles_of_a_step_go_when_it_has_ended(spark, sf_dir):
    """What the interactions are built of is written; nothing that was shuffled for it stays on disk behind it."""
    before = shuffle_files(spark)
    table = registry.queries()["user_product_interactions"](spark, sf_dir.replace("sf0.01", "sf0.001"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    # A frame that is run again finds its rows again.
    assert len(table.collect()) == len(table.collect()) > 0


def test_a_batch_is_shuffled_once_for_its_check_and_its_comparison(spark):
    schema = "review_id string, asin string, reviewer_id string, review_timestamp timestamp, {}text_hash string, model_version string, embedding array<float>"
    batch = spark.createDataFrame([("R1", "A", "U", None, None, "h", "m", [1.0])], schema.format("ingest_dt date, "))
    stored = spark.createDataFrame([], schema.format("") + ", created_at timestamp, updated_at timestamp").where("false")
    changed = vectors.changed_vectors(stored, batch, F.current_timestamp())
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(changed))) == 1
    assert [r["review_id"] for r in changed.collect()] == ["R1"]


def test_ids_are_packed_while_reviews_are_shuffled(spark, stored_reviews):
    facts = features.review_facts(stored_reviews)
    users, stats = features.user_features(facts, "2024-01-02"), features.product_review_stats(facts, "2024-01-02")
    products = spark.createDataFrame([], "asin string, title string, brand string, price double, title_length int, description_total_length int, main_category string")
    for made in (stats, features.user_product_interactions(facts, products, users, stats, "2024-01-02", reviews_are_unique=True)):
        made.collect()
        final = plan_of(made)
        assert "unhex(review_id" in final and "(hex(substring(review_id" in final
    assert sorted(r["review_id"] for r in made.collect()) == sorted(r["review_id"] for r in facts.collect())
