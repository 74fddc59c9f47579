"""Named queries over the sample tables, one or more per operator.

Each takes the session and the folder of the tables. Results are flat: arrays and maps become text, doubles are
rounded, timestamps lose their zone, so that they can be compared with any SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import parse, text, vectors
from gristmill.operators import checks, contracts, dedup, profile, quality, topk, upsert
from gristmill.operators.dealing import deal_by_cost
from gristmill.operators.embedding import hashed_tokens
from gristmill.plans import features, incremental, refresh, staging, suites
from gristmill.plans import vectors as vector_plans
from gristmill.session import TABLE_SETTINGS, fresh_dir, materialize, tune
from gristmill.sources import landing, raw, samples, tables
from gristmill.streaming import cursor

INGEST_DT = "2024-01-01"
RUN_DATE = "2024-01-02"
EARLIER = "2024-02-01 12:00:00"
NOW = "2024-03-01 12:00:00"
LATER = "2024-04-01 12:00:00"
CURSOR_START = "2024-01-10 00:00:00"
DIGITS = 6
SAMPLE_DIM = 64

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a function under its name; it runs with the package's session settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(function(tune(spark, TABLE_SETTINGS), sf_dir))

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def flat(df: DataFrame) -> DataFrame:
    return df.select(*[_flat(f).alias(f.name) for f in df.schema])


def _flat(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.DoubleType):
        return F.round(c, DIGITS)
    if isinstance(f.dataType, T.TimestampType):
        return c.cast("timestamp_ntz")
    if isinstance(f.dataType, T.ArrayType):
        return F.array_join(c.cast("array<string>"), "|", "<null>")
    if isinstance(f.dataType, T.MapType):
        return parse.map_text(c)
    return c


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _scaled(vector: str) -> Column:
    """A vector as text of whole millionths."""
    return F.array_join(F.transform(vector, lambda x: F.round(x.cast("double") * 1e6).cast("bigint")), ",")


# Staging and features


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.products(samples.raw_products(spark, sf_dir), INGEST_DT)


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.reviews(samples.raw_reviews(spark, sf_dir), INGEST_DT)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.review_facts(samples.raw_reviews(spark, sf_dir), INGEST_DT)


def _feature_tables(spark: SparkSession, sf_dir: str) -> dict[str, Any]:
    """The feature tables. Reviews feed three of them, so their facts are written once and read three times.

    Beside the tables: the facts, and under ``joined`` what the interactions were joined with.
    """
    reviews = materialize(_facts(spark, sf_dir), "review-facts")
    products = features.product_features(_products(spark, sf_dir), RUN_DATE)
    users = features.user_features(reviews, RUN_DATE)
    stats = features.product_review_stats(reviews, RUN_DATE)
    base = {"product_features": products, "user_features": users, "product_review_stats": stats}
    # What the interactions take of each is written, so that the shuffles behind it are gone before the reviews are joined.
    joined = [materialize(features.joined_columns(name, df), name.replace("_", "-")) for name, df in base.items()]
    # Staging has made the reviews unique.
    interactions = features.user_product_interactions(reviews, *joined, RUN_DATE, reviews_are_unique=True)
    return {**base, "user_product_interactions": interactions, "review_facts": reviews, "joined": joined}


@query
def staging_products(spark, sf_dir):
    return _products(spark, sf_dir)


@query
def staging_reviews(spark, sf_dir):
    return _reviews(spark, sf_dir)


@query
def product_features(spark, sf_dir):
    return features.product_features(_products(spark, sf_dir), RUN_DATE)


@query
def user_features(spark, sf_dir):
    return features.user_features(_facts(spark, sf_dir), RUN_DATE)


@query
def product_review_stats(spark, sf_dir):
    return features.product_review_stats(_facts(spark, sf_dir), RUN_DATE)


@query
def user_product_interactions(spark, sf_dir):
    return _feature_tables(spark, sf_dir)["user_product_interactions"]


@query
def interactions_of_repeated_reviews(spark, sf_dir):
    """The same table when every review is delivered twice: reviews are made unique, and written, before the joins."""
    found = _feature_tables(spark, sf_dir)
    twice = found["review_facts"].unionByName(found["review_facts"])
    once = materialize(features.distinct_reviews(twice), "distinct-reviews")
    return features.user_product_interactions(once, *found["joined"], RUN_DATE, reviews_are_unique=True)


@query
def refresh_row_counts(spark, sf_dir):
    """The whole sequence from raw batches to checked tables and vectors, reported as rows per table."""
    root = fresh_dir(spark, "refresh")
    run = refresh.Run(spark, root, INGEST_DT, RUN_DATE, NOW)
    counts = run.all(
        samples.raw_products(spark, sf_dir),
        samples.raw_reviews(spark, sf_dir),
        hashed_tokens(SAMPLE_DIM),
        SAMPLE_DIM,
        model_version="hashed-64",
    )
    return counts


@query
def incremental_refresh(spark, sf_dir):
    """Staging reviews after two increments of one date and a third without rows.

    The first run sees reviews before the median time only.
    """
    source = samples.raw_reviews(spark, sf_dir)
    middle = source.agg(F.percentile_approx("unixReviewTime", 0.5).alias("m")).first()["m"]
    run = refresh.Run(spark, fresh_dir(spark, "increments"), INGEST_DT, RUN_DATE, NOW)
    taken = []
    for visible in (source.where(F.col("unixReviewTime") <= middle), source, source):
        manifest = run.ingest(visible, "reviews", "unixReviewTime", incremental=True)
        taken.append(manifest.header.first()["counts"]["records"])
        if taken[-1]:
            run.stage("reviews", source.schema)
            run.commit(manifest, "reviews")
    return run.staged("reviews").select(
        "*",
        F.lit(sum(taken)).cast("bigint").alias("records_taken"),
        F.lit(taken[-1]).cast("bigint").alias("records_of_third_run"),
    )


def _feature_state(spark: SparkSession, sf_dir: str) -> incremental.FeatureState:
    """The state after three increments and one that comes twice; each replaces some reviews of those before it."""
    reviews = features.with_review_id(materialize(_facts(spark, sf_dir), "review-facts"))
    share = F.pmod(F.xxhash64("review_id"), F.lit(4))
    # Earlier versions of a review have other votes, flags and lengths.
    earlier = reviews.withColumns({
        "vote_count": F.coalesce("vote_count", F.lit(3)) + 5,
        "verified": ~F.coalesce("verified", F.lit(False)),
        "review_text_length": F.col("review_text_length") * 2 + 1,
    })
    state = incremental.FeatureState(spark, fresh_dir(spark, "feature-state"), buckets=8)
    parts = (earlier.where(share < 2), earlier.where(share == 2).unionByName(reviews.where(share == 0)), reviews.where(share != 0))
    for number, part in enumerate(parts):
        state.apply(part, f"increment {number}")
        state.sweep()
    state.apply(earlier, "increment 2")
    return state


@query
def user_features_incremental(spark, sf_dir):
    """Reviewer features kept up to date over increments with replaced reviews."""
    return _feature_state(spark, sf_dir).user_features(RUN_DATE)


@query
def product_stats_incremental(spark, sf_dir):
    """Product statistics kept up to date over increments with replaced reviews."""
    return _feature_state(spark, sf_dir).product_review_stats(RUN_DATE)


# Scalar functions


@query
def normalize_strings(spark, sf_dir):
    raw_rows = samples.raw_products(spark, sf_dir)
    return raw_rows.select("asin", "updated_at", *[text.blank_to_null(F.col(c)).alias(c) for c in ("title", "brand", "date_raw")])


@query
def parse_price(spark, sf_dir):
    raw_rows = samples.raw_products(spark, sf_dir)
    return raw_rows.select("asin", "updated_at", "price_raw", parse.parse_price(F.col("price_raw")).alias("price"))


@query
def extract_price(spark, sf_dir):
    """Price taken from whichever column the frame offers: raw text, typed value, or nothing."""
    raw_rows = samples.raw_products(spark, sf_dir).select("asin", "updated_at", "price_raw")
    parsed = raw_rows.select("*", features.price_of(raw_rows).alias("from_raw"))
    typed = parsed.withColumn("price", F.col("from_raw") * 2)
    bare = typed.select("asin")
    return typed.select("asin", "updated_at", "from_raw", features.price_of(typed).alias("from_typed"), features.price_of(bare).alias("from_nothing"))


@query
def parse_vote(spark, sf_dir):
    reviews = samples.raw_reviews(spark, sf_dir)
    return reviews.select("_id", "vote", parse.parse_vote(F.col("vote")).alias("vote_count"))


@query
def parse_review_date(spark, sf_dir):
    reviews = samples.raw_reviews(spark, sf_dir)
    broken = F.when(F.col("vote").isNull(), F.concat(F.lit("13 "), F.col("reviewTime"))).otherwise(F.col("reviewTime"))
    return reviews.select("_id", "reviewTime", parse.parse_review_date(broken).alias("review_time"))


@query
def unix_to_timestamp(spark, sf_dir):
    reviews = samples.raw_reviews(spark, sf_dir)
    return reviews.select("_id", parse.epoch_to_timestamp(F.col("unixReviewTime")).alias("review_timestamp"))


@query
def review_id_hash(spark, sf_dir):
    reviews = samples.raw_reviews(spark, sf_dir)
    rating = F.when(F.col("verified").isNotNull(), F.col("overall"))
    key = parse.review_key(F.col("asin"), F.col("reviewerID"), F.col("unixReviewTime"), rating)
    return reviews.select("_id", key.alias("review_id"))


@query
def optional_columns(spark, sf_dir):
    """Staging of a feed that knows neither votes nor styles."""
    reviews = samples.raw_reviews(spark, sf_dir).drop("vote", "style")
    return staging.reviews(reviews, INGEST_DT).select("review_id", "vote_count", "style")


@query
def normalize_arrays(spark, sf_dir):
    raw_rows = samples.raw_products(spark, sf_dir)
    names = ["category", "description", "feature", "rank", "also_buy", "also_view"]
    arrays = [parse.string_array(F.col(n), raw_rows.schema[n].dataType).alias(n) for n in names]
    return raw_rows.select("asin", "updated_at", *arrays)


@query
def array_total_length(spark, sf_dir):
    raw_rows = samples.raw_products(spark, sf_dir)
    lengths = [
        parse.array_text_length(F.col(n), raw_rows.schema[n].dataType).alias(f"{n}_length")
        for n in ("category", "description", "rank")
    ]
    return raw_rows.select("asin", "updated_at", *lengths)


@query
def struct_to_map(spark, sf_dir):
    reviews = samples.raw_reviews(spark, sf_dir)
    return reviews.select("_id", parse.string_map(F.col("style"), reviews.schema["style"].dataType).alias("style"))


@query
def clean_text(spark, sf_dir):
    pages = samples.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


# Landing lines


@query
def safe_json_ingest(spark, sf_dir):
    fields = {"asin": "string", "title": "string", "price": "string", "props": "string"}
    documents = landing.valid_documents(samples.landing_lines(spark, sf_dir), fields, "asin")
    return documents.select("doc.*")


@query
def json_project(spark, sf_dir):
    return landing.product_documents(samples.landing_lines(spark, sf_dir))


@query
def distinct_on_longest(spark, sf_dir):
    documents = landing.valid_documents(samples.landing_lines(spark, sf_dir), {"asin": "string"}, "asin")
    return dedup.longest_by(documents.select(F.col("doc.asin").alias("asin"), "line"), ["asin"], "line")


@query
def dedup_latest_by_key(spark, sf_dir):
    return dedup.latest_by(samples.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


# Counts and profiles


@query
def null_key_guard(spark, sf_dir):
    raw_rows = samples.raw_products(spark, sf_dir)
    keyed = raw_rows.select(
        text.blank_to_null(F.col("asin")).alias("asin"),
        text.blank_to_null(F.col("brand")).alias("brand"),
        parse.parse_timestamp(F.col("updated_at")).alias("updated_at"),
    )
    return contracts.null_counts(keyed, ["asin", "brand", "updated_at"])


@query
def key_null_counts(spark, sf_dir):
    return contracts.null_counts(features.product_features(_products(spark, sf_dir), RUN_DATE), ["asin"])


@query
def load_counts(spark, sf_dir):
    return profile.key_counts(samples.raw_products(spark, sf_dir), "asin")


@query
def profile_rating_stats(spark, sf_dir):
    return profile.rating_stats(_mixed_ratings(spark, sf_dir), "overall")


@query
def profile_rating_distribution(spark, sf_dir):
    return profile.rating_distribution(_mixed_ratings(spark, sf_dir), "overall")


def _mixed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as text, some of them no numbers."""
    reviews = samples.raw_reviews(spark, sf_dir)
    rating = F.when(F.col("reviewText").isNull(), "n/a").otherwise(F.col("overall").cast("string"))
    return reviews.withColumn("overall", rating)


@query
def profile_text_length(spark, sf_dir):
    return profile.text_length_profile(samples.raw_reviews(spark, sf_dir), "reviewText")


@query
def profile_freshness(spark, sf_dir):
    cutoff = profile.window_start(F.lit("2001-11-04 00:00:00").cast("timestamp"))
    return profile.freshness(samples.raw_reviews(spark, sf_dir), "unixReviewTime", cutoff)


@query
def table_row_counts(spark, sf_dir):
    found = _feature_tables(spark, sf_dir)
    return checks.row_counts({name: found[name] for name in refresh.FEATURE_TABLES})


# Vectors


@query
def embedding_text(spark, sf_dir):
    prepared = vector_plans.prepare(_document_reviews(spark, sf_dir), "hashed-64")
    return prepared


def _document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of staging reviews; German ones have no summary, some summaries are blank."""
    documents = samples.table(spark, sf_dir, "documents")
    summary = F.when(F.col("lang") == "de", F.lit(None)).when(F.col("source") == "src1", "  ")
    return documents.select(
        F.concat(F.lit("D"), "doc_id").alias("review_id"),
        F.col("source").alias("asin"),
        F.col("lang").alias("reviewer_id"),
        F.timestamp_seconds(F.lit(1600000000) + F.col("doc_id")).alias("review_timestamp"),
        F.lit(INGEST_DT).cast("date").alias("ingest_dt"),
        summary.otherwise(F.concat(F.lit("From &quot;"), "source", F.lit("&quot;"))).alias("summary"),
        F.col("text").alias("review_text"),
    )


@query
def embed_documents(spark, sf_dir):
    # Documents are dealt before their texts are cleaned, which costs as much as the encoder here.
    documents = deal_by_cost(_document_reviews(spark, sf_dir), F.length("review_text"))
    prepared = materialize(vector_plans.prepare(documents, "hashed-64"), "prepared")
    embedded = vector_plans.embed_reviews(prepared, hashed_tokens(SAMPLE_DIM))
    return embedded.select("review_id", "text_hash", "model_version", _scaled("embedding").alias("embedding"))


@query
def embedding_incremental(spark, sf_dir):
    """Documents still to embed when labelled ones are stored, the toxic ones with an older text."""
    prepared = materialize(vector_plans.prepare(_document_reviews(spark, sf_dir), "hashed-64"), "prepared")
    labels = samples.table(spark, sf_dir, "labels").select(F.concat(F.lit("D"), "doc_id").alias("review_id"), "toxic")
    stored = labels.join(prepared, "review_id").select(
        "review_id",
        F.when(F.col("toxic") == 1, F.sha2("text_hash", 256)).otherwise(F.col("text_hash")).alias("text_hash"),
        "model_version",
    )
    return vector_plans.pending(prepared, stored).select("review_id", "text_hash", "model_version")


@query
def l2_normalize(spark, sf_dir):
    scale = F.when(F.col("label") == 0, 0.0).when(F.col("label") == 1, 3.0).otherwise(1.0).cast("float")
    table = samples.table(spark, sf_dir, "embeddings").withColumn("scale", scale)
    scaled = F.zip_with("embedding", F.array_repeat("scale", F.size("embedding")), lambda x, s: (x * s).cast("float"))
    unit = table.select("vec_id", vectors.l2_normalize(scaled).alias("unit"))
    return unit.select("vec_id", _scaled("unit").alias("unit"))


@query
def vector_literal(spark, sf_dir):
    table = samples.table(spark, sf_dir, "embeddings")
    literal = table.select("vec_id", vectors.vector_literal(F.col("embedding"), SAMPLE_DIM).alias("literal"))
    parsed = literal.select("vec_id", F.from_json("literal", "array<double>").alias("v"), "literal")
    bracketed = F.startswith(F.col("literal"), F.lit("[")) & F.endswith(F.col("literal"), F.lit("]"))
    return parsed.select("vec_id", _scaled("v").alias("components"), bracketed.alias("bracketed"))


@query
def vector_table_counts(spark, sf_dir):
    return checks.vector_counts(samples.stored_vectors(spark, sf_dir))


@query
def vector_dim_histogram(spark, sf_dir):
    return checks.dimension_histogram(_damaged_vectors(spark, sf_dir))


@query
def vector_table_checks(spark, sf_dir):
    return checks.vector_checks(_damaged_vectors(spark, sf_dir), SAMPLE_DIM)


def _damaged_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors where asin A1 lost its vectors, A2's are too short, A3's have no hash and A4's share an id."""
    stored = samples.stored_vectors(spark, sf_dir)
    asin = F.col("asin")
    return stored.select(
        F.when(asin == "A4", "R-same").otherwise(F.col("review_id")).alias("review_id"),
        F.when(asin == "A1", F.lit(None))
        .when(asin == "A2", F.slice("embedding", 1, 10))
        .otherwise(F.col("embedding"))
        .alias("embedding"),
        "model_version",
        F.when(asin != "A3", F.col("text_hash")).alias("text_hash"),
    )


@query
def vector_preview(spark, sf_dir):
    return checks.vector_preview(samples.stored_vectors(spark, sf_dir))


@query
def cosine_topk(spark, sf_dir):
    """The ten vectors nearest to the mean vector of each label."""
    table = samples.table(spark, sf_dir, "embeddings")
    means = [F.avg(F.get("embedding", F.lit(i))) for i in range(SAMPLE_DIM)]
    centers = table.groupBy("label").agg(F.array(*means).alias("center"))
    asked = centers.select(F.col("label").cast("string").alias("query"), F.col("center").alias("vector"))
    nearest = topk.cosine_topk_join(table, asked, 10, id_column="vec_id").withColumn("score", F.round("score", DIGITS))
    shown = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return nearest.withColumn("rank", F.row_number().over(shown))


@query
def cosine_topk_all(spark, sf_dir):
    """The ten vectors nearest to each vector of the table, itself among them."""
    table = samples.table(spark, sf_dir, "embeddings")
    asked = table.select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    nearest = topk.cosine_topk_join(table, asked, 10, id_column="vec_id").withColumn("score", F.round("score", DIGITS))
    shown = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return nearest.withColumn("rank", F.row_number().over(shown))


@query
def embedding_upsert(spark, sf_dir):
    stored = samples.stored_vectors(spark, sf_dir)
    changed = vector_plans.changed_vectors(stored, samples.vector_batch(spark, sf_dir), _now())
    merged = vector_plans.apply_changes(stored, materialize(changed, "changed-vectors"), _now())
    return merged.select(*[c for c in merged.columns if c != "embedding"], _scaled("embedding").alias("components"))


def _vector_run(spark: SparkSession, root: str, now: str, reviews: DataFrame) -> refresh.Run:
    """A run over reviews that are staged already."""
    run = refresh.Run(spark, root, INGEST_DT, RUN_DATE, now)
    tables.write_partitions(reviews, run.staging_path("reviews"))
    return run


def _vectors_with_versions(run: refresh.Run) -> DataFrame:
    written = tables.current_version(run.spark, run.vector_path).number
    stored = run.vector_table()
    return stored.select(
        "review_id", "text_hash", "model_version", "created_at", "updated_at", _scaled("embedding").alias("embedding")
    ).withColumn("versions_written", F.lit(written).cast("bigint"))


@query
def vector_refresh_rerun(spark, sf_dir):
    """The lasting vector table after three runs: English documents, all documents, and all again without a change."""
    root = fresh_dir(spark, "vector-refresh")
    documents = _document_reviews(spark, sf_dir)
    for now, reviews in ((EARLIER, documents.where("reviewer_id = 'en'")), (NOW, documents), (LATER, None)):
        # The third run finds what was staged for the second.
        run = refresh.Run(spark, root, INGEST_DT, RUN_DATE, now) if reviews is None else _vector_run(spark, root, now, reviews)
        run.build_vectors(hashed_tokens(SAMPLE_DIM), SAMPLE_DIM, model_version="hashed-64")
    return _vectors_with_versions(run)


@query
def vector_refresh_two_writers(spark, sf_dir):
    """The vector table after a run over German documents and two more that started from its result at the same time.

    One of the two has all documents and commits first; the other has the English ones with another model.
    """
    root = fresh_dir(spark, "two-writers")
    documents = _document_reviews(spark, sf_dir)
    encoder = hashed_tokens(SAMPLE_DIM)
    _vector_run(spark, root, EARLIER, documents.where("reviewer_id = 'de'")).build_vectors(encoder, SAMPLE_DIM, "hashed-64")
    drafts = []
    for now, reviews, model in ((NOW, documents, "hashed-64"), (LATER, documents.where("reviewer_id = 'en'"), "hashed-64b")):
        run = refresh.Run(spark, root, INGEST_DT, RUN_DATE, now)
        drafts.append((run, run.draft_vectors(vector_plans.prepare(reviews, model), encoder)))
    for run, draft in drafts:
        run.commit_vectors(draft, SAMPLE_DIM)
    return _vectors_with_versions(run)


@query
def batch_key_check(spark, sf_dir):
    """Keys that come more than once in the landing lines, before and after the longest record of each is taken."""
    documents = landing.valid_documents(samples.landing_lines(spark, sf_dir), {"asin": "string"}, "asin")
    before = documents.select(F.col("doc.asin").alias("asin"), "line")
    after = dedup.longest_by(before, ["asin"], "line")
    return upsert.key_check(before, ["asin"]).withColumn("step", F.lit("landed")).unionByName(
        upsert.key_check(after, ["asin"]).withColumn("step", F.lit("unique"))
    )


@query
def product_upsert(spark, sf_dir):
    """Landing documents merged into a product table keyed by customer number."""
    customers = samples.table(spark, sf_dir, "customer")
    earlier = F.lit("2024-01-01 00:00:00").cast("timestamp")
    target = customers.select(
        F.concat(F.lit("A"), F.col("c_custkey") + 20).alias("asin"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("brand"),
        F.lit("1").alias("price_raw"),
        F.lit("2024-01-01").cast("date").alias("ingest_dt"),
        earlier.alias("updated_at"),
    )
    batch = landing.product_documents(samples.landing_lines(spark, sf_dir))
    batch = materialize(batch.withColumn("ingest_dt", F.lit("2024-02-01").cast("date")), "landed-products")
    return upsert.upsert(target, batch, ["asin"], _now())


@query
def stats_merge(spark, sf_dir):
    orders = samples.table(spark, sf_dir, "orders")
    earlier = F.lit("2024-01-01 00:00:00").cast("timestamp")
    by_priority = orders.groupBy(F.col("o_orderpriority").alias("_id")).agg(
        F.avg("o_totalprice").alias("avg_rating"),
        F.count(F.lit(1)).alias("total_reviews"),
        F.lit(1704067200).cast("bigint").alias("last_updated"),
    )
    stale = profile.stats_document(orders, "o_totalprice", earlier)
    fresh = profile.stats_document(_mixed_ratings(spark, sf_dir), "overall", _now())
    return upsert.upsert(by_priority.unionByName(stale), fresh, ["_id"], _now())


# Quality suites


def _suite(name: str, df: DataFrame) -> DataFrame:
    return quality.evaluate(df, suites.BY_TABLE[name])


@query
def dq_suite_products(spark, sf_dir):
    return _suite("staging_products", materialize(_products(spark, sf_dir), "staging-products"))


@query
def dq_suite_reviews(spark, sf_dir):
    return _suite("staging_reviews", materialize(_reviews(spark, sf_dir), "staging-reviews"))


@query
def dq_suite_product_features(spark, sf_dir):
    table = materialize(features.product_features(_products(spark, sf_dir), RUN_DATE), "product-features")
    return _suite("product_features", table)


@query
def dq_suite_user_features(spark, sf_dir):
    table = materialize(features.user_features(_facts(spark, sf_dir), RUN_DATE), "user-features")
    return _suite("user_features", table)


@query
def dq_suite_review_stats(spark, sf_dir):
    table = materialize(features.product_review_stats(_facts(spark, sf_dir), RUN_DATE), "review-stats")
    return _suite("product_review_stats", table)


@query
def dq_suite_interactions(spark, sf_dir):
    table = materialize(_feature_tables(spark, sf_dir)["user_product_interactions"], "interactions")
    return _suite("user_product_interactions", table)


@query
def dq_failing_suite(spark, sf_dir):
    """A suite whose checks fail in every way, over raw reviews."""
    return quality.evaluate(samples.raw_reviews(spark, sf_dir), FAILING_SUITE)


FAILING_SUITE = quality.flatten(
    [
        quality.not_null("verified"),
        quality.not_null("summary", mostly=0.4, severity="warning"),
        quality.unique("reviewText"),
        quality.between("overall", 2, 4, mostly=0.5),
        quality.between("unixReviewTime", high=900_000_000),
        quality.in_set("vote", "7", "30", "31"),
        quality.exists("absent"),
        quality.of_type("overall", "float32"),
        quality.in_type_list("vote", "int64", "int32"),
        quality.non_null_share("vote", 0.9, 1.0),
        quality.between("absent", 0),
    ]
)


@query
def dq_unexpected_sample(spark, sf_dir):
    return quality.unexpected_sample(_reviews(spark, sf_dir), quality.between("vote_count", 0, 40))


# Storage


def _raw_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, raw.Batch]:
    events = samples.table(spark, sf_dir, "events")
    root = fresh_dir(spark, "raw")
    return events, root, raw.write_batch(events, root, "events", INGEST_DT, cursor_field="ts")


def _manifest(spark: SparkSession, root: str, batch: raw.Batch) -> raw.Manifest:
    reached = raw.Cursor("ts", watermark_out=batch.last_cursor)
    built = raw.build_manifest(spark, batch, "events", INGEST_DT, "2024-01-01T00:00:00Z", cursor=reached)
    path = raw.manifest_path(root, "events", INGEST_DT)
    raw.write_manifest(built, path)
    return raw.read_manifest(spark, path)


@query
def raw_scan_manifest(spark, sf_dir):
    events, root, batch = _raw_events(spark, sf_dir)
    stored = raw.read_raw(spark, _manifest(spark, root, batch), _as_text(events))
    return stored.withColumn("ts", F.col("ts").cast("timestamp"))


def _as_text(events: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == "ts" else f.dataType) for f in events.schema])


@query
def raw_sink_counts(spark, sf_dir):
    _, _, batch = _raw_events(spark, sf_dir)
    per_file = raw.records_per_file(spark, batch)
    return per_file.agg(
        F.sum("records").alias("records"), F.every(F.col("records") <= raw.RECORDS_PER_FILE).alias("within_limit")
    )


@query
def manifest_build(spark, sf_dir):
    _, root, batch = _raw_events(spark, sf_dir)
    manifest = _manifest(spark, root, batch)
    return manifest.header.select(
        "manifest_version",
        F.col("source.name").alias("source_name"),
        F.col("run.ingest_dt").alias("ingest_dt"),
        "run.extract_ts_utc",
        "run.mode",
        "s3.prefix",
        "s3.format",
        F.col("counts.records").alias("records"),
        (F.col("counts.files") == F.lit(manifest.files.count())).alias("all_files_listed"),
        F.col("incremental.enabled").alias("incremental_enabled"),
        "incremental.cursor_field",
        "incremental.watermark_in",
        F.col("incremental.watermark_out").cast("timestamp").alias("watermark_out"),
    )


@query
def reconcile_counts(spark, sf_dir):
    """What came from the source against what is read back from the files, and the files that changed since: none."""
    _, root, batch = _raw_events(spark, sf_dir)
    manifest = _manifest(spark, root, batch)
    row = raw.reconcile(manifest, batch.records)
    changed = raw.audit(spark, manifest).agg(F.count(F.lit(1)).alias("changed_files"))
    return changed.select(
        F.lit(row.source_records).cast("bigint").alias("source_records"),
        F.lit(row.written_records).cast("bigint").alias("written_records"),
        F.lit(row.lines_match).alias("lines_match"),
        F.lit(row.matches).alias("matches"),
        "changed_files",
    )


def _orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.table(spark, sf_dir, "orders")
    return orders.withColumn("ingest_dt", F.trunc(F.col("o_orderdate").cast("date"), "year"))


@query
def partition_scan(spark, sf_dir):
    path = fresh_dir(spark, "orders-by-year")
    tables.write_partitions(_orders_by_year(spark, sf_dir), path, sort_by="o_custkey", spread=True)
    return tables.read_partition(spark, path, "1997-01-01")


@query
def dynamic_overwrite(spark, sf_dir):
    """Orders by year; a second write replaces the years from 1998 on and leaves the others alone."""
    path = fresh_dir(spark, "orders-overwritten")
    orders = _orders_by_year(spark, sf_dir)
    tables.write_partitions(orders, path, spread=True)
    later = orders.where(F.col("ingest_dt") >= F.lit("1998-01-01").cast("date"))
    tables.write_partitions(later.withColumn("o_totalprice", F.col("o_totalprice") * 2), path, spread=True)
    return tables.read_all(spark, path)


@query
def table_replace(spark, sf_dir):
    """A catalog table published three times: as it is, with another column, and from its own content."""
    root = fresh_dir(spark, "catalog")
    name = f"orders_{root[-12:]}"
    orders = samples.table(spark, sf_dir, "orders")
    tables.publish_table(orders, name, root=root)
    tables.publish_table(tables.read_table(spark, name).withColumn("doubled", F.col("o_totalprice") * 2), name, root=root)
    doubled = tables.read_table(spark, name).withColumn("o_totalprice", F.col("doubled")).drop("doubled")
    tables.publish_table(doubled, name, root=root)
    last = spark.table(name).inputFiles()
    spark.sql(f"DROP VIEW {name}")
    return spark.read.parquet(*sorted({f.rsplit("/", 1)[0] for f in last}))


@query
def incremental_extract(spark, sf_dir):
    return cursor.after(samples.table(spark, sf_dir, "events"), "ts", CURSOR_START)


@query
def watermark_advance(spark, sf_dir):
    """The watermark log after a first run that took everything and a second that found nothing new."""
    events = samples.table(spark, sf_dir, "events")
    root = fresh_dir(spark, "state")
    start = cursor.read_state(spark, root, "events")
    reached = cursor.watermark_out(cursor.pending(events, "ts", start), "ts")
    cursor.commit(spark, root, "events", "ts", start, reached)
    stored = cursor.last_watermark(spark, root, "events")
    return cursor.after(events, "ts", stored).agg(
        F.count(F.lit(1)).alias("rows_left"), F.lit(stored).cast("timestamp").alias("watermark")
    )


@query
def incremental_boundary(spark, sf_dir):
    """Events and the run that took each, with the day as cursor, which errors lack.

    The first run sees two thirds of the events up to the twentieth day, the second one all up to then: what it takes shares the
    watermark, has no cursor, or lies in the five days of overlap below it. The third sees the same as the second; the
    fourth sees every event.
    """
    events = samples.table(spark, sf_dir, "events")
    day = F.to_date("ts")
    source = events.withColumn("day", F.when(F.col("event_type") != "error", day)).withColumn("seen", day)
    until = F.lit("2024-01-20").cast("date")
    some = source.where((F.col("seen") <= until) & (F.col("event_id") % 3 != 0))
    run = refresh.Run(spark, fresh_dir(spark, "boundary"), INGEST_DT, RUN_DATE, NOW)
    taken = []
    for number, visible in enumerate((some, source.where(F.col("seen") <= until), source.where(F.col("seen") <= until), source), 1):
        manifest = run.ingest(visible.drop("seen"), "events", "day", incremental=True, overlap="5 days")
        run.commit(manifest, "events")
        rows = raw.read_raw(spark, manifest, "event_id bigint") if manifest.header.first()["counts"]["records"] else None
        if rows is not None:
            taken.append(rows.withColumn("run", F.lit(number).cast("bigint")))
    return reduce(DataFrame.unionByName, taken)


@query
def versions_retained(spark, sf_dir):
    """A table written six times and swept: folders removed, versions that can still be read, and the current rows."""
    orders = samples.table(spark, sf_dir, "orders")
    base = fresh_dir(spark, "retained")
    for number in range(1, 7):
        path = tables.new_version_path(base)
        orders.where(F.col("o_orderkey") % 6 < number).write.parquet(path)
        tables.commit_version(spark, base, tables.current_version(spark, base), {0: path})
    removed = tables.sweep_versions(spark, base, keep=2, grace_seconds=0)
    kept = tables.version_log(spark, base).numbers()
    current = tables.current_version(spark, base).read(spark)
    return current.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(removed).cast("bigint").alias("folders_removed"),
        F.lit(",".join(map(str, kept))).alias("versions_kept"),
    )
