"""Operators on small frames, against brute force where there is something to compute."""

import datetime as dt
import random

import duckdb
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from gristmill.operators import checks, contracts, dedup, embedding, profile, quality, topk, upsert
from gristmill.plans import suites

NOW = dt.datetime(2024, 3, 1)
OLD = dt.datetime(2024, 1, 1)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# De-duplication


def test_latest_by_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    data = [
        (rng.choice(["hot"] * 10 + [f"k{i}" for i in range(20)]), rng.choice([None, 1, 2, 3]), rng.choice("abc"))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "k string, t int, v string").repartition(8)
    best = {}
    for key, time, value in data:
        candidate = (time is not None, time or 0, value)
        best[key] = max(best.get(key, candidate), candidate)
    expected = sorted((k, t if known else None, v) for k, (known, t, v) in best.items())
    assert rows(dedup.latest_by(df, ["k"], "t")) == expected


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = dedup.latest_by(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "row_number(), 1, Partial" in plan[exchange:]


def test_dedup_by_key_without_order_column_is_stable(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "k string, v string")
    assert rows(dedup.dedup_by_key(df, "k")) == [("a", "y"), ("b", "z")]
    with pytest.raises(ValueError, match="missing columns: nope"):
        dedup.dedup_by_key(df, "nope")


def test_longest_by_and_maps(spark):
    df = spark.createDataFrame([("a", "xx"), ("a", "y"), ("b", "z")], "k string, v string")
    assert rows(dedup.longest_by(df, ["k"], "v")) == [("a", "xx"), ("b", "z")]
    mapped = spark.sql("SELECT 1 AS k, map('a', 'b') AS m UNION ALL SELECT 1, map('a', 'c')")
    assert dedup.distinct_by(mapped, ["k"]).collect() == [Row(k=1, m={"a": "c"})]


# Contracts


def test_contracts(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert contracts.require_columns(df, ["k"]) is df
    with pytest.raises(ValueError, match="missing columns: x, y"):
        contracts.require_columns(df, ["y", "x", "k"])
    with pytest.raises(ValueError, match="nothing is empty"):
        contracts.require_rows(df.where("false"), "nothing")
    assert contracts.null_counts(df, ["k"]).first() == Row(total_rows=2, null_k_count=1)
    with pytest.raises(PySparkException, match="null k"):
        df.select(contracts.never_null(F.col("k"), "k")).collect()


# Upserts

SCHEMA = "review_id string, asin string, text_hash string, model_version string, created_at timestamp, updated_at timestamp"


def stored(spark):
    data = [
        ("same", "A", "h1", "m1", OLD, OLD),
        ("newtext", "A", "h1", "m1", OLD, OLD),
        ("newmodel", "A", "h1", "m1", OLD, OLD),
        ("nohash", "A", None, "m1", OLD, OLD),
        ("absent", "A", "h1", "m1", OLD, OLD),
    ]
    return spark.createDataFrame(data, SCHEMA)


def incoming(spark):
    data = [
        ("same", "B", "h1", "m1"),
        ("newtext", "B", "h2", "m1"),
        ("newmodel", "B", "h1", "m2"),
        ("nohash", "B", "h1", "m1"),
        ("new", "B", "h9", "m1"),
    ]
    return spark.createDataFrame(data, "review_id string, asin string, text_hash string, model_version string")


def test_gated_upsert_and_rerun(spark):
    gate = upsert.differs("text_hash", "model_version")
    now = F.lit(NOW)
    merged = upsert.upsert(stored(spark), incoming(spark), ["review_id"], now, gate)
    got = rows(merged)
    assert got == [
        ("absent", "A", "h1", "m1", OLD, OLD),
        ("new", "B", "h9", "m1", NOW, NOW),
        ("newmodel", "B", "h1", "m2", OLD, NOW),
        ("newtext", "B", "h2", "m1", OLD, NOW),
        ("nohash", "B", "h1", "m1", OLD, NOW),
        ("same", "A", "h1", "m1", OLD, OLD),
    ]
    later = F.lit(dt.datetime(2025, 1, 1))
    again = upsert.upsert(merged, incoming(spark), ["review_id"], later, gate)
    assert rows(again) == got


def test_merge_statement_gives_the_same_rows(spark):
    gate = upsert.differs("text_hash", "model_version")
    con = duckdb.connect()
    con.execute(f"CREATE TABLE target ({SCHEMA.replace('string', 'VARCHAR')})")
    con.executemany("INSERT INTO target VALUES (?, ?, ?, ?, ?, ?)", [list(r) for r in stored(spark).collect()])
    con.execute("CREATE TABLE batch (review_id VARCHAR, asin VARCHAR, text_hash VARCHAR, model_version VARCHAR)")
    con.executemany("INSERT INTO batch VALUES (?, ?, ?, ?)", [list(r) for r in incoming(spark).collect()])
    columns = incoming(spark).columns
    con.execute(upsert.merge_statement("target", "batch", columns, ["review_id"], "TIMESTAMP '2024-03-01 00:00:00'", gate))
    merged = upsert.upsert(stored(spark), incoming(spark), ["review_id"], F.lit(NOW), gate)
    assert sorted(con.sql("SELECT * FROM target").fetchall(), key=str) == sorted(map(tuple, merged.collect()), key=str)


def test_merge_into_needs_a_table_that_can_merge(spark):
    """Spark resolves every column of the statement and then refuses, as a view cannot take rows."""
    stored(spark).createOrReplaceTempView("plain_rows")
    with pytest.raises(PySparkException, match="MERGE INTO TABLE"):
        upsert.merge_into(incoming(spark), "plain_rows", ["review_id"], upsert.differs("text_hash"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("merge_batch")]


def test_unconditional_upsert(spark):
    merged = upsert.upsert(stored(spark), incoming(spark), ["review_id"], F.lit(NOW))
    assert ("same", "B", "h1", "m1", OLD, NOW) in rows(merged)


def test_not_stored_yet(spark):
    left = upsert.not_stored_yet(incoming(spark), stored(spark), ["review_id", "text_hash", "model_version"])
    assert rows(left, "review_id") == [("new",), ("newmodel",), ("newtext",), ("nohash",)]


def test_small_batch_is_broadcast_and_large_store_stays_in_place(spark):
    store = spark.range(200_000).selectExpr("CAST(id AS string) AS review_id", "'h' AS text_hash", "'m' AS model_version")
    batch = spark.createDataFrame([("5", "x", "m")], "review_id string, text_hash string, model_version string")
    merged = upsert.upsert(store, batch, ["review_id"], F.lit(NOW), upsert.differs("text_hash"))
    merged.write.format("noop").mode("overwrite").save()
    assert merged.where("review_id = '5'").first()["text_hash"] == "x"
    assert merged.count() == 200_000


# Profiles


def test_rating_profiles_skip_what_is_no_number(spark):
    df = spark.createDataFrame([("5",), ("4.0",), ("n/a",), (None,)], "overall string")
    assert profile.rating_stats(df, "overall").first() == Row(avg_rating=4.5, min_rating=4.0, max_rating=5.0, total_reviews=2)
    assert [tuple(r) for r in profile.rating_distribution(df, "overall").collect()] == [(5.0, 1), (4.0, 1)]


def test_text_length_counts_code_points(spark):
    df = spark.createDataFrame([("😀a",), (None,)], "t string")
    assert profile.text_length_profile(df, "t").first() == Row(avg_length=1.0, max_length=2)


def test_freshness_window(spark):
    df = spark.createDataFrame([(0,), (400 * 86400,), (None,)], "s bigint")
    cutoff = profile.window_start(F.timestamp_seconds(F.lit(500 * 86400)))
    got = profile.freshness(df, "s", cutoff).first()
    assert got == Row(newest=dt.datetime(1971, 2, 5), oldest=dt.datetime(1970, 1, 1), reviews_in_last_year=1)


# Data-product checks


def test_vector_checks_on_clean_and_empty_tables(spark):
    columns = "review_id string, embedding array<float>, model_version string, text_hash string"
    good = spark.createDataFrame([("a", [1.0, 0.0], "m", "h"), ("b", [0.0, 1.0], "m", "h")], columns)
    assert all(r["passed"] for r in checks.vector_checks(good, 2).collect())
    report = checks.vector_report(good, 2, "review_embeddings", "now").first()
    assert report["overall_status"] == "success" and len(report["checks"]) == 4
    empty = {r["check_name"]: r["passed"] for r in checks.vector_checks(good.where("false"), 2).collect()}
    assert empty == {
        "table_not_empty": False,
        "no_nulls_in_required_columns": True,
        "no_duplicate_review_id": True,
        "all_embeddings_have_expected_dimension": True,
    }


# Quality


def results(df, *suite):
    return {r["position"]: r for r in quality.evaluate(df, suite).collect()}


def test_checks_ignore_nulls_and_count_every_repeat(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 9), (None, 5)], "k string, n int")
    got = results(df, quality.unique("k"), quality.between("n", 1, 5), quality.in_set("k", "a"), quality.not_null("k"))
    assert [got[i]["unexpected_count"] for i in range(4)] == [2, 1, 1, 1]
    assert [got[i]["missing_count"] for i in range(4)] == [1, 1, 1, None]
    assert not any(got[i]["success"] for i in range(4))
    assert got[1]["unexpected_percent"] == pytest.approx(100 / 3)
    assert got[1]["unexpected_percent_total"] == 25.0
    assert got[3]["unexpected_percent"] == 25.0


def test_mostly_decides_by_share(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "n int")
    got = results(df, quality.between("n", 1, mostly=0.95), quality.between("n", 1, mostly=0.96))
    assert [got[0]["success"], got[1]["success"]] == [True, False]


def test_empty_frame_passes_row_checks(spark):
    df = spark.createDataFrame([], "n int")
    got = results(df, quality.between("n", 1), quality.not_null("n"), quality.unique("n"), quality.non_null_share("n", 0.5, 1))
    assert [got[i]["success"] for i in range(4)] == [True, True, True, False]


def test_quoted_names_and_values(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",)], "`odd name` string")
    got = results(df, quality.in_set("odd name", "it's", "a\\b"), *quality.exists("odd name", "other"))
    assert [got[i]["success"] for i in range(3)] == [True, True, False]


def test_run_suite_samples_report_and_gate(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(200)], "n int")
    suite = quality.flatten([quality.between("n", 0, 9, severity="warning"), quality.exists("n"), quality.unique("n")])
    outcome = quality.run_suite(df, "numbers", suite)
    assert not outcome.success and len(outcome.failed) == 2
    assert outcome.samples[0] == sorted([10, 11, 12, 13, 14] * 4)
    assert outcome.samples[2] == sorted([0, 1, 2, 3, 4] * 4)
    document = quality.report(outcome, suite, execution_date="2024-01-02", table_name="t")
    assert document["expectations"][0]["expectation_config"]["kwargs"] == {"column": "n", "min_value": 0, "max_value": 9}
    assert document["expectations"][1] == {
        "success": True,
        "expectation_config": {"type": quality.EXISTS, "kwargs": {"column": "n"}, "severity": "critical"},
        "result": {},
    }
    with pytest.raises(quality.SuiteFailed, match="numbers"):
        quality.enforce(outcome)


def test_suite_runs_in_two_scans(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    suite = [quality.unique("a")] + [quality.between("b", i) for i in range(20)]
    plan = quality.evaluate(df, suite)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3


# Vectors


def test_encoder_runs_in_batches_and_keeps_rows(spark):
    texts = [f"word{i % 7} tail" for i in range(100)] + [""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: r["v"] for r in df.select("id", embedding.embed(F.col("t"), embedding.hashed_tokens(16), 8).alias("v")).collect()}
    expected = embedding.unit_rows(embedding.hashed_tokens(16)()(texts))
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert np.array_equal(np.float32(got[i]), expected[i])


def test_cosine_topk_equals_brute_force_with_copies(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(300, 8)).astype(np.float32)
    matrix[100:200] = matrix[0]
    data = [(f"r{i:03d}", [float(x) for x in row]) for i, row in enumerate(matrix)]
    df = spark.createDataFrame(data, "review_id string, embedding array<float>").repartition(7)
    queries = {"q0": [float(x) for x in matrix[0]], "q1": [float(x) for x in rng.normal(size=8)]}
    unit = matrix.astype(np.float64) / np.linalg.norm(matrix.astype(np.float64), axis=1)[:, None]
    expected = []
    for name, vector in queries.items():
        q = np.array(vector) / np.linalg.norm(vector)
        scores = np.rint(unit @ q * 1e12) / 1e12
        order = sorted(range(300), key=lambda i: (-scores[i], data[i][0]))[:5]
        expected += [(name, rank + 1, data[i][0], scores[i]) for rank, i in enumerate(order)]
    got = rows(topk.cosine_topk(df, queries, 5))
    assert [r[:3] for r in got] == [r[:3] for r in sorted(expected)]
    assert np.allclose([r[3] for r in got], [r[3] for r in sorted(expected)], atol=1e-11)
    one_per_scan = topk.cosine_topk(df, queries, 5, query_bytes=64)
    assert rows(one_per_scan) == sorted(expected)


def test_topk_in_slices_of_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(150)], "review_id int, embedding array<double>")
    queries = {f"q{i}": [float(x) for x in rng.normal(size=5)] for i in range(6)}
    whole = rows(topk.cosine_topk(df, queries, 7))
    monkeypatch.setattr(topk, "SCORE_BYTES", 8 * 6 * 4)
    assert rows(topk.cosine_topk(df, queries, 7)) == whole


def test_pruned_topk_equals_brute_force_and_skips_cells(spark):
    rng = np.random.default_rng(6)
    spots = rng.normal(size=(12, 16))
    matrix = np.concatenate([spots[i % 12] + 0.05 * rng.normal(size=16) for i in range(600)]).reshape(600, 16)
    matrix[10] = 0.0
    stored = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(matrix)], "id int, v array<double>").repartition(3)
    asked = [*range(0, 600, 40), 10]
    far = {1000: (-spots[0]).tolist(), 1001: rng.normal(size=16).tolist()}
    vectors = {q: matrix[q].tolist() for q in asked} | far
    frame = spark.createDataFrame([(q, v) for q, v in vectors.items()], "query int, vector array<double>")
    lengths = np.linalg.norm(matrix, axis=1)
    unit = matrix / np.where(lengths == 0, 1.0, lengths)[:, None]
    for k, pivots in ((5, 24), (5, 1), (400, 24)):
        got = {}
        for r in topk.cosine_topk_join(stored, frame, k, id_column="id", vector_column="v", block_rows=40, block_queries=4, pivots=pivots, cell_rows=1).orderBy("query", "rank").collect():
            got.setdefault(r["query"], []).append(r["id"])
        for q, v in vectors.items():
            n = np.linalg.norm(v) or 1.0
            scores = np.rint(unit @ (np.array(v) / n) * 1e12) / 1e12
            assert got[q] == sorted(range(600), key=lambda i: (-scores[i], i))[:k], (q, k, pivots)
    cells = topk._cells(stored, 24, 40)
    near = topk._assigned(frame.where("query < 1000 AND query <> 10").withColumnRenamed("vector", "v"), "query", cells.pivots)
    known = near.withColumn("group", F.lit(0)).withColumn("kth", F.lit(0.95))
    searched = [len(r["cells"]) for r in topk._with_cells(known, cells).collect()]
    assert np.mean(searched) < 0.4 * sum(n > 0 for n in cells.parts)


def test_topk_join_of_nothing_and_of_zeros(spark):
    schema = "id int, v array<double>"
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query int, vector array<double>")
    search = lambda rows: topk.cosine_topk_join(spark.createDataFrame(rows, schema), asked, 2, id_column="id", vector_column="v")
    assert search([]).isEmpty() and search([(1, None)]).isEmpty()
    assert sorted(r["id"] for r in search([(3, [0.0, 0.0]), (2, [0.0, 0.0]), (1, [0.0, 0.0])]).collect()) == [1, 2]


def test_topk_ranks_on_full_scores_and_rejects_other_lengths(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0004]), ("b", [1.0, 0.0]), ("c", None)], "review_id string, embedding array<double>")
    assert [r["review_id"] for r in topk.cosine_topk(df, {"q": [1.0, 0.0]}, 2).orderBy("rank").collect()] == ["b", "a"]
    longer = df.unionByName(spark.createDataFrame([("d", [1.0, 0.0, 0.0])], df.schema))
    with pytest.raises(Exception, match="another length"):
        topk.cosine_topk(longer, {"q": [1.0, 0.0]}, 2).collect()


def test_upsert_fails_on_repeated_or_null_keys(spark):
    target = spark.createDataFrame([(1, "x")], "k long, v string")
    for keys in ([2, 2], [3, None]):
        batch = spark.createDataFrame([(k, "y") for k in keys], "k long, v string")
        with pytest.raises(Exception, match="null or repeated key"):
            upsert.upsert(target, batch, ["k"], F.current_timestamp()).collect()


def test_only_plain_finite_numbers_count_as_ratings(spark):
    df = spark.createDataFrame([(x,) for x in ("5", " 4.5 ", "NaN", "Infinity", "5d", "1e400", "n/a", None)], "overall string")
    assert sorted(r["overall"] for r in profile.numeric_only(df, "overall").collect()) == [4.5, 5.0]


def test_null_text_has_no_vector(spark):
    df = spark.createDataFrame([("a b",), (None,)], "text string")
    got = df.select("text", embedding.embed(F.col("text"), embedding.hashed_tokens(8)).alias("v")).collect()
    assert {r["text"]: r["v"] is None for r in got} == {"a b": False, None: True}


def test_key_check_counts_what_a_merge_refuses(spark):
    batch = spark.sql("SELECT * FROM VALUES ('a'), ('a'), ('b'), (CAST(NULL AS string)), (CAST(NULL AS string)) AS t(k)")
    assert upsert.key_check(batch, ["k"]).first()[:] == (5, 3, 1, 2)
    assert upsert.key_check(batch.where("false"), ["k"]).first()[:] == (0, 0, 0, 0)


def test_topk_join_equals_brute_force_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(200, 6))
    matrix[50:100] = matrix[0]
    matrix[150] = 0.0
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(matrix)] + [(999, None)], "review_id int, embedding array<double>")
    asked = df.where("review_id % 9 = 0").selectExpr("CAST(review_id AS string) AS query", "embedding AS vector")
    lengths = np.linalg.norm(matrix, axis=1)
    unit = matrix / np.where(lengths == 0, 1.0, lengths)[:, None]
    expected = {}
    for q in range(0, 200, 9):
        scores = np.rint(unit @ unit[q] * 1e12) / 1e12
        expected[str(q)] = sorted(range(200), key=lambda i: (-scores[i], i))[:4]
    got = {}
    for row in topk.cosine_topk_join(df, asked, 4, block_rows=30, block_queries=5, cell_rows=20).orderBy("query", "rank").collect():
        got.setdefault(row["query"], []).append(row["review_id"])
    assert got == expected
    assert topk.cosine_topk_join(df, asked.where("false"), 4).isEmpty()
    longer = spark.createDataFrame([("x", [1.0])], asked.schema)
    with pytest.raises(Exception, match="length"):
        topk.cosine_topk_join(df, longer, 4).collect()


@pytest.mark.parametrize("table", sorted(suites.BY_TABLE))
def test_every_check_of_a_suite_can_fail(spark, table):
    """A table without the columns fails every check; a suite of the same checks over empty columns fails the null checks."""
    suite = suites.BY_TABLE[table]
    without = quality.evaluate(spark.range(2).toDF("nothing_known"), suite).collect()
    assert len(without) == len(suite) and not any(r["success"] for r in without)
    names = sorted({check.column for check in suite})
    empty = spark.range(2).select(*[F.lit(None).cast("string").alias(n) for n in names])
    failed = {(r["expectation"], r["column"]) for r in quality.evaluate(empty, suite).collect() if not r["success"]}
    assert {(c.expectation, c.column) for c in suite if c.expectation in (quality.NOT_NULL, quality.NON_NULL_SHARE)} <= failed


def test_topk_join_moves_a_vector_once_per_block_not_per_few_queries(spark, monkeypatch):
    moved = []
    scorer = topk._block_scorer

    def counted(k):
        score, seen = scorer(k), spark.sparkContext.accumulator(0)
        moved.append(seen)

        def run(stored, asked):
            seen.add(stored.num_rows)
            return score(stored, asked)

        return run

    monkeypatch.setattr(topk, "_block_scorer", counted)
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(3000, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(matrix)], "id int, embedding array<float>")
    asked = df.selectExpr("id AS query", "embedding AS vector")
    got = topk.cosine_topk_join(df, asked, 3, id_column="id", block_rows=1000, block_queries=1000, cell_rows=50).collect()
    # Three blocks or four, and as many groups: before, 180 groups of 17 queries.
    assert sum(m.value for m in moved) <= 5 * 3000
    unit = matrix.astype(float) / np.linalg.norm(matrix.astype(float), axis=1)[:, None]
    for q in range(0, 3000, 500):
        scores = np.rint(unit @ unit[q] * 1e12) / 1e12
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == q] == sorted(range(3000), key=lambda i: (-scores[i], i))[:3]


def test_cells_are_packed_into_blocks():
    assert topk._packed([3, 4, 0, 25, 2, 9, 1], 10) == ([0, 0, 0, 1, 4, 5, 5], [1, 1, 0, 3, 1, 1, 1])
