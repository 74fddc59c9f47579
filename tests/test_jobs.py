"""Jobs end to end: staging quirks, features, storage, gates, reruns."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gristmill.operators import quality
from gristmill.operators.embedding import hashed_tokens
from gristmill.plans import features, refresh, staging, vectors
from gristmill.sources import extract, landing, raw, samples, tables
from gristmill.streaming import cursor

REVIEW = {
    "_id": "1",
    "overall": 4.0,
    "vote": "1,045",
    "verified": True,
    "reviewTime": "09 2, 2016",
    "reviewerID": " U1 ",
    "asin": "A1",
    "reviewText": "good",
    "summary": None,
    "unixReviewTime": 1472774400,
    "style": None,
}
REVIEW_SCHEMA = (
    "_id string, overall double, vote string, verified boolean, reviewTime string, reviewerID string, asin string, "
    "reviewText string, summary string, unixReviewTime bigint, style struct<color: string, size: string>"
)


def reviews(spark, *changes):
    return spark.createDataFrame([{**REVIEW, **c} for c in changes], REVIEW_SCHEMA)


def test_reviews_with_equal_keys_collapse_to_the_most_voted(spark):
    raw_rows = reviews(spark, {}, {"vote": None, "reviewText": "other"}, {"overall": 5.0})
    staged = staging.reviews(raw_rows, "2024-01-01")
    assert sorted((r["rating"], r["vote_count"], r["review_text"]) for r in staged.collect()) == [
        (4.0, 1045, "good"),
        (5.0, 1045, "good"),
    ]
    row = staged.first()
    assert row["reviewer_id"] == "U1" and row["style"] == {} and row["review_time"] == dt.date(2016, 9, 2)
    assert row["ingest_dt"] == dt.date(2024, 1, 1) and row["source_system"] == "mongodb"


def test_missing_columns_stop_staging(spark):
    with pytest.raises(ValueError, match="missing columns: asin, summary"):
        staging.reviews(reviews(spark, {}).drop("asin", "summary"), "2024-01-01")


def product(**changes):
    base = dict.fromkeys(staging.RAW_PRODUCT_COLUMNS)
    return {**base, "asin": "A1", "updated_at": "2024-01-01T00:00:00", "category": ["c"], **changes}


PRODUCT_SCHEMA = ", ".join(
    f"`{c}` {'array<string>' if c in ('category', 'description', 'feature') else 'string'}"
    for c in staging.RAW_PRODUCT_COLUMNS
)


def products(spark, *rows):
    return spark.createDataFrame([product(**r) for r in rows], PRODUCT_SCHEMA)


def test_product_staging_keeps_the_latest(spark):
    staged = staging.products(products(spark, {"title": "old"}, {"title": "new", "updated_at": "2024-02-01"}), "2024-01-01")
    row = staged.first()
    assert staged.count() == 1 and row["title"] == "new" and row["rank_raw"] == [None] and row["features"] == []


@pytest.mark.parametrize("broken", [{"asin": "  "}, {"updated_at": "yesterday"}])
def test_products_without_key_or_time_stop_the_job(spark, broken):
    with pytest.raises(PySparkException, match="null (asin|updated_at)"):
        staging.products(products(spark, {}, broken), "2024-01-01").collect()


def staged_reviews(spark, sf_dir):
    return staging.reviews(samples.raw_reviews(spark, sf_dir), "2024-01-01")


def test_feature_invariants(spark, sf_dir):
    staged = staged_reviews(spark, sf_dir).cache()
    users = features.user_features(staged, "2024-01-02").cache()
    stats = features.product_review_stats(staged, "2024-01-02").cache()
    items = features.product_features(staging.products(samples.raw_products(spark, sf_dir), "2024-01-01"), "2024-01-02")
    table = features.user_product_interactions(staged, items, users, stats, "2024-01-02")
    assert table.count() == staged.count() == users.agg(F.sum("reviews_count")).first()[0]
    unknown = table.where("product_title_length IS NULL")
    assert unknown.count() > 0 and unknown.where("product_has_description IS NOT NULL").isEmpty()
    assert table.where("user_reviews_count IS NULL OR product_reviews_count IS NULL").isEmpty()


def test_single_review_has_zero_deviation(spark):
    staged = staging.reviews(reviews(spark, {}, {"asin": "A2", "overall": 4.0}, {"asin": "A2", "reviewerID": "U2", "overall": 5.0}), "2024-01-01")
    got = {r["asin"]: r["rating_stddev"] for r in features.product_review_stats(staged, "2024-01-02").collect()}
    assert got["A1"] == 0.0 and got["A2"] == pytest.approx(0.707107, abs=1e-6)


def test_hot_product_is_split_by_the_adaptive_planner(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        n = 60_000
        staged = spark.range(0, n, 1, 8).selectExpr(
            "sha2(CAST(id AS string), 256) AS review_id", "CONCAT('U', id % 5000) AS reviewer_id",
            "IF(id % 3 = 0, 'hot', CONCAT('A', id % 997)) AS asin", "CAST(id % 5 + 1 AS double) AS rating",
            "1 AS vote_count", "true AS verified", "'t' AS review_text", "'s' AS summary",
            "timestamp_seconds(id) AS review_timestamp",
        )
        items = staged.select("asin").distinct().selectExpr(
            "asin", "asin AS title", "asin AS brand", "1.0D AS price", "1 AS title_length",
            "1 AS description_total_length", "'m' AS main_category",
        )
        users = features.user_features(staged, "2024-01-02")
        stats = features.product_review_stats(staged, "2024-01-02")
        table = features.user_product_interactions(staged, items, users, stats, "2024-01-02")
        table.write.format("noop").mode("overwrite").save()
        collected = table.collect()
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert len(collected) == n
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Storage


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.sql("SELECT DATE'2024-01-01' AS ingest_dt, 1 AS v UNION ALL SELECT DATE'2024-01-02', 2")
    tables.write_partitions(first, path)
    tables.write_partitions(spark.sql("SELECT DATE'2024-01-02' AS ingest_dt, 9 AS v"), path)
    assert sorted(r["v"] for r in tables.read_all(spark, path).collect()) == [1, 9]
    pruned = tables.read_partition(spark, path, "2024-01-02")
    assert [tuple(r) for r in pruned.select("ingest_dt", "v").collect()] == [(dt.date(2024, 1, 2), 9)]
    assert "PartitionFilters: [isnotnull(ingest_dt" in pruned._jdf.queryExecution().executedPlan().toString()


def test_published_table_can_be_replaced_from_itself(spark, tmp_path):
    root = str(tmp_path)
    tables.publish_table(spark.range(3).toDF("v"), "published", root=root)
    tables.publish_table(tables.read_table(spark, "published").selectExpr("v + 10 AS v"), "published", root=root)
    assert sorted(r["v"] for r in spark.table("published").collect()) == [10, 11, 12]
    tables.publish_table(spark.sql("SELECT 'x' AS other"), "published", root=root)
    assert spark.table("published").columns == ["other"]
    spark.sql("DROP VIEW published")


def test_raw_batches_files_and_manifest(spark, tmp_path):
    root = str(tmp_path)
    source = spark.range(25).selectExpr("id", "CAST(NULL AS string) AS empty", "timestamp_seconds(id) AS ts", "DATE'2024-01-01' AS d").coalesce(1)
    batch = raw.write_batch(source, root, "things", "2024-01-01", records_per_file=10, cursor_field="id")
    assert batch.last_cursor == "24"
    assert batch.path.startswith(f"{root}/raw/things/ingest_dt=2024-01-01/") and batch.records == 25
    per_file = {r["file"]: r["records"] for r in raw.records_per_file(spark, batch).collect()}
    assert sorted(per_file.values()) == [5, 10, 10]
    assert sorted(r["file"] for r in raw.batch_files(spark, batch).collect()) == sorted(per_file)
    other = raw.write_batch(source, root, "things", "2024-01-01")
    assert other.path != batch.path
    path = raw.manifest_path(root, "things", "2024-01-01")
    for number, written in enumerate((batch, other), 1):
        built = raw.build_manifest(spark, written, "things", "2024-01-01", "2024-01-01T00:00:00Z", batch_no=number)
        raw.write_manifest(built, path)
    assert raw.next_batch_no(spark, path) == 3
    manifest = raw.read_manifest(spark, path, batch.name)
    row = manifest.header.first()
    assert manifest.header.count() == 1 and row["counts"]["records"] == 25 and row["counts"]["files"] == 3
    assert {r["file"] for r in manifest.files.collect()} == set(per_file)
    stored = raw.read_raw(spark, manifest, source.schema)
    assert stored.columns == source.columns
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, source.collect()), key=str)
    assert raw.reconcile(manifest, 25).matches and not raw.reconcile(manifest, 26).matches
    counting = raw.read_manifest(spark, path).header.collect()
    assert [r["s3"]["batch"] for r in counting] == [other.name]
    with pytest.raises(ValueError, match="lists no files"):
        raw.read_raw(spark, raw.Manifest(manifest.header.where("false"), manifest.files))


@pytest.mark.parametrize("change", ["stray", "missing"])
def test_folder_and_manifest_must_agree(spark, tmp_path, change):
    root = str(tmp_path)
    batch = raw.write_batch(spark.range(6).coalesce(1), root, "raw", "2024-01-01", records_per_file=2)
    manifest = raw.build_manifest(spark, batch, "raw", "2024-01-01", "t")
    path = raw.manifest_path(root, "raw", "2024-01-01")
    raw.write_manifest(manifest, path)
    manifest = raw.read_manifest(spark, path)
    assert raw.read_raw(spark, manifest).count() == 6
    files = sorted((tmp_path / batch.prefix / batch.name).glob("part-*"))
    if change == "stray":
        (files[0].parent / "part-stray.json").write_text('{"id": 7}\n')
    else:
        files[0].unlink()
    with pytest.raises(ValueError, match="manifest and folder differ: raw/raw/ingest_dt=2024-01-01/batch-.*/part-"):
        raw.read_raw(spark, manifest)


def test_empty_batch_has_a_manifest_without_records(spark, tmp_path):
    batch = raw.write_batch(spark.range(3).where("id > 5"), str(tmp_path), "things", "2024-01-01", cursor_field="id")
    assert batch.records == 0 and batch.last_cursor is None
    manifest = raw.build_manifest(spark, batch, "things", "2024-01-01", "t")
    row = manifest.header.first()
    assert row["counts"]["records"] == 0 and row["counts"]["files"] == manifest.files.count()


def test_indented_manifest_document(spark, tmp_path):
    document = {
        "manifest_version": "1.0",
        "source": {"name": "x"},
        "s3": {"bucket": str(tmp_path), "prefix": "raw/x/", "format": "jsonl.gz", "files": ["raw/x/a.json"]},
    }
    (tmp_path / "raw" / "x").mkdir(parents=True)
    (tmp_path / "raw" / "x" / "a.json").write_text('{"v": 1}\n{"v": 2}\n')
    (tmp_path / "manifest.json").write_text(json.dumps(document, indent=2))
    manifest = raw.read_document(spark, str(tmp_path / "manifest.json"))
    assert raw.read_raw(spark, manifest).count() == 2


def test_landing_lines_accept_exactly_one_object(spark):
    good = ['{"asin":"a"}', '  {"asin":"b"} ', '{"asin":7}', '{"asin":"c","asin":"d"}']
    bad = ['{"asin":"x"', '{"asin":"x"} y', '{"asin":"x"},{"asin":"y"}', "{'asin':'x'}", '"text"', '[{"asin":"x"}]', '{"asin":""}', "{}", ""]
    lines = spark.createDataFrame([(line,) for line in good + bad], "line string")
    got = landing.valid_documents(lines, {"asin": "string"}, "asin").select("doc.asin").collect()
    assert sorted(r[0] for r in got) == ["7", "a", "b", "d"]


def test_landing_projection_and_file(spark, tmp_path):
    lines = ['{"asin":"a","category":["x","y"],"rank":"5","date":"d","imageURL":[]}', '{"asin":"a","title":"t"}', "junk"]
    (tmp_path / "lines.txt").write_text("\n".join(lines))
    row = landing.product_documents(landing.read_lines(spark, str(tmp_path / "lines.txt"))).collect()
    assert len(row) == 1
    assert (row[0]["category"], row[0]["rank"], row[0]["date_raw"], row[0]["image_url"], row[0]["title"]) == (["x", "y"], ["5"], "d", [], None)


def test_relational_options():
    plain = extract.relational_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "5000"}
    split = extract.relational_options("jdbc:x", "t", split=("id", 0, 100, 4), user="u")
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4" and split["user"] == "u"


def test_documents_through_any_format(spark, tmp_path):
    spark.range(3).write.json(str(tmp_path / "d"))
    assert extract.read_documents(spark, "json", {"path": str(tmp_path / "d")}, "id bigint").count() == 3


def test_cursor_log(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(10).toDF("n")
    assert cursor.last_watermark(spark, root, "e") is None
    assert cursor.after(df, "n", None).count() == 10
    first = cursor.commit(spark, root, "e", "n", cursor.State(), cursor.watermark_out(df.where("n < 5"), "n"))
    cursor.commit(spark, root, "e", "n", first, "7")
    assert cursor.last_watermark(spark, root, "e") == "7"
    assert [r["n"] for r in cursor.after(df, "n", "7").collect()] == [8, 9]
    assert cursor.watermark_out(df.where("false"), "n") is None


def test_incremental_ingestion_moves_the_watermark_with_the_commit(spark, tmp_path):
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00")
    source = spark.range(10).toDF("n")
    first = run.ingest(source.where("n < 6"), "things", "n", incremental=True)
    row = first.header.first()
    assert row["counts"]["records"] == 6 and row["run"]["mode"] == "incremental"
    assert row["incremental"].asDict() == {"enabled": True, "cursor_field": "n", "watermark_in": None, "watermark_out": "5"}
    assert cursor.last_watermark(spark, str(tmp_path), "things") is None
    run.commit(first, "things")
    second = run.ingest(source, "things", "n", incremental=True)
    row = second.header.first()
    assert (row["incremental"]["watermark_in"], row["incremental"]["watermark_out"]) == ("5", "9")
    assert sorted(r["n"] for r in raw.read_raw(spark, second, source.schema).collect()) == [6, 7, 8, 9]
    run.commit(second, "things")
    third = run.ingest(source, "things", "n", incremental=True)
    run.commit(third, "things")
    assert third.header.first()["counts"]["records"] == 0
    assert cursor.last_watermark(spark, str(tmp_path), "things") == "9"


def timed(spark, *times):
    return reviews(spark, *[{"unixReviewTime": REVIEW["unixReviewTime"] + t, "overall": float(t % 5 + 1)} for t in times])


def increment(run, source, until=None):
    manifest = run.ingest(source, "reviews", "unixReviewTime", incremental=True)
    if until == "ingest":
        return
    run.stage("reviews", source.schema)
    run.commit(manifest, "reviews")


def test_increments_of_one_date_add_up(spark, tmp_path):
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00")
    increment(run, timed(spark, *range(6)))
    increment(run, timed(spark, *range(10)))
    assert run.staged("reviews").count() == 10
    run.ingest(timed(spark, *range(3)), "reviews")
    run.stage("reviews", timed(spark, 1).schema)
    assert run.staged("reviews").count() == 3  # a complete extract replaces the date


def test_run_that_dies_before_staging_loses_nothing(spark, tmp_path):
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00")
    increment(run, timed(spark, *range(6)))
    increment(run, timed(spark, *range(10)), until="ingest")
    increment(run, timed(spark, *range(10)))
    assert run.staged("reviews").count() == 10 == run.staged("reviews").select("review_id").distinct().count()


def test_increments_of_several_dates_are_features_of_all(spark, tmp_path):
    rows = [{}, {"asin": "A2", "unixReviewTime": REVIEW["unixReviewTime"] + 60}]
    known = {"title": "t", "brand": "b", "main_cat": "m", "price_raw": "$1", "description": ["d"], "feature": ["f"]}
    goods = products(spark, known, known | {"asin": "A2", "updated_at": "2024-01-05T00:00:00"})
    cursors = {"products": "updated_at", "reviews": "unixReviewTime"}
    counts = []
    for day, seen in (("2024-01-01", rows[:1]), ("2024-01-02", rows), ("2024-01-03", rows)):
        run = refresh.Run(spark, str(tmp_path), day, day, f"{day} 12:00:00", vector_buckets=2)
        done = run.all(goods, reviews(spark, *seen), hashed_tokens(8), 8, "v1", cursors=cursors)
        counts.append({r["table_name"]: r["row_count"] for r in done.collect()})
    assert counts[0]["user_product_interactions"] == counts[0]["review_embeddings"] == 1
    assert counts[1] == counts[2]
    assert counts[2]["user_product_interactions"] == counts[2]["review_embeddings"] == counts[2]["product_features"] == 2


# The whole sequence


def test_refresh_with_catalog_and_rerun(spark, sf_dir, tmp_path):
    small = sf_dir.replace("sf0.01", "sf0.001")
    spark.sql("CREATE DATABASE IF NOT EXISTS mlready")
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00", namespace="mlready")
    source = samples.raw_products(spark, small), samples.raw_reviews(spark, small)
    counts = {r["table_name"]: r["row_count"] for r in run.all(*source, hashed_tokens(8), 8, "v1").collect()}
    assert counts["user_product_interactions"] == 6000 and spark.table("mlready.user_features").count() == counts["user_features"]
    vectors_before = tables.current_version(spark, run.vector_path)
    again = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-03", "2024-04-01 12:00:00", namespace="mlready")
    second = {r["table_name"]: r["row_count"] for r in again.all(*source, hashed_tokens(8), 8, "v1").collect()}
    assert second == counts
    assert tables.current_version(spark, again.vector_path) == vectors_before
    table = again.vector_table()
    assert table.count() == table.select("review_id").distinct().count() == counts["review_embeddings"]
    assert table.where("updated_at <> TIMESTAMP'2024-03-01 12:00:00'").isEmpty()
    report = json.loads("".join(r[0] for r in spark.read.text(f"{tmp_path}/reports/user_features/2024-01-02").collect()))
    assert report["success"] and report["table_name"] == "mlready.user_features" and len(report["expectations"]) == 26


def test_gate_saves_the_report_before_it_stops(spark, tmp_path):
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00")
    broken = staging.reviews(reviews(spark, {"overall": 9.0}), "2024-01-01")
    with pytest.raises(quality.SuiteFailed, match="between.*rating"):
        run.gate(broken, "staging_reviews")
    report = json.loads(spark.read.text(f"{tmp_path}/reports/staging_reviews/2024-01-02").first()[0])
    failed = [e for e in report["expectations"] if not e["success"]]
    assert len(failed) == 1 and failed[0]["result"]["partial_unexpected_list"] == [9.0]


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00", vector_buckets=4)
    texts = [{"asin": f"A{i}", "reviewText": f"text {i}"} for i in range(40)]
    tables.write_partitions(staging.reviews(reviews(spark, *texts), "2024-01-01"), run.staging_path("reviews"))
    assert run.build_vectors(hashed_tokens(8), 8, "v1").count() == 40
    first = tables.current_version(spark, run.vector_path)
    texts[0]["reviewText"] = "another text"
    tables.write_partitions(staging.reviews(reviews(spark, *texts), "2024-01-01"), run.staging_path("reviews"))
    run.now = "2024-04-01 12:00:00"
    table = run.build_vectors(hashed_tokens(8), 8, "v1")
    second = tables.current_version(spark, run.vector_path)
    assert second.number == 2 and sum(first.parts[b] != second.parts[b] for b in first.parts) == 1
    assert table.count() == 40 and table.where("updated_at > created_at").count() == 1


@pytest.mark.parametrize("namespace", [None, "checked"])
def test_failed_feature_version_never_becomes_current(spark, tmp_path, namespace):
    spark.sql("CREATE DATABASE IF NOT EXISTS checked")
    run = refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", "2024-03-01 12:00:00", namespace=namespace)
    good = features.user_features(features.review_facts(staging.reviews(reviews(spark, {}), "2024-01-01")), "2024-01-02")
    run.publish("user_features", good)
    with pytest.raises(quality.SuiteFailed):
        run.publish("user_features", good.withColumn("avg_rating", F.lit(9.0)))
    assert run.feature("user_features").first()["avg_rating"] == 4.0


def test_pending_skips_what_is_stored(spark):
    staged = staging.reviews(reviews(spark, {}, {"asin": "A2", "reviewText": None}), "2024-01-01")
    prepared = vectors.prepare(staged, "m1")
    assert prepared.count() == 1
    assert vectors.pending(prepared, prepared).isEmpty()
    assert vectors.pending(vectors.prepare(staged, "m2"), prepared).count() == 1
