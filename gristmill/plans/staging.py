"""Raw records to typed, de-duplicated staging tables. Each is one projection and one ranking by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import parse
from gristmill.functions.text import blank_to_null, text_length
from gristmill.operators.contracts import never_null, require_columns
from gristmill.operators.dedup import digest_order, first_per_key, newest
from gristmill.plans.features import KEYED_FACTS

# The raw contract, in the sources' own field names.
RAW_PRODUCT_COLUMNS = [
    "asin",
    "title",
    "brand",
    "main_cat",
    "category",
    "description",
    "feature",
    "rank",
    "also_buy",
    "also_view",
    "similar_item",
    "date_raw",
    "price_raw",
    "ingest_dt",
    "updated_at",
]
RAW_REVIEW_COLUMNS = [
    "_id",
    "overall",
    "verified",
    "reviewTime",
    "reviewerID",
    "asin",
    "reviewText",
    "summary",
    "unixReviewTime",
]

# The staging reviews.
REVIEW_COLUMNS = [
    "review_id",
    "asin",
    "reviewer_id",
    "rating",
    "vote_count",
    "review_text",
    "summary",
    "review_time",
    "review_timestamp",
    "verified",
    "style",
    "ingest_dt",
    "source_system",
]

_KEY, _STYLE = "_review_key", "_raw_style"

PRODUCT_SOURCE = "postgres"
REVIEW_SOURCE = "mongodb"


def _batch_date(ingest_dt: str) -> Column:
    return F.lit(ingest_dt).cast("date").alias("ingest_dt")


def products(raw: DataFrame, ingest_dt: str, source_system: str = PRODUCT_SOURCE) -> DataFrame:
    """Staging products: the latest version of each product.

    A record without a key or a readable update time ends the job.
    """
    require_columns(raw, RAW_PRODUCT_COLUMNS)
    types = {f.name: f.dataType for f in raw.schema}

    def text(name: str) -> Column:
        return blank_to_null(F.col(name).cast("string"))

    def array(name: str) -> Column:
        return parse.string_array(F.col(name), types[name])

    typed = raw.select(
        never_null(text("asin"), "asin").alias("asin"),
        text("title").alias("title"),
        text("brand").alias("brand"),
        text("main_cat").alias("main_category"),
        array("category").alias("categories"),
        array("description").alias("description"),
        array("feature").alias("features"),
        array("also_buy").alias("also_buy"),
        array("also_view").alias("also_view"),
        array("rank").alias("rank_raw"),
        parse.parse_price(F.col("price_raw")).alias("price"),
        text("similar_item").alias("similar_item"),
        text("date_raw").alias("date_raw"),
        _batch_date(ingest_dt),
        never_null(parse.parse_timestamp(F.col("updated_at")), "updated_at").alias("updated_at"),
        F.lit(source_system).alias("source_system"),
    )
    order = newest("updated_at") + digest_order(typed, ["asin", "updated_at", "ingest_dt", "source_system"])
    # A small file that holds many products is one task. Dealt by their content, records are sorted in tasks of bounded size, and those
    # of one product are still limited before they meet.
    dealt = typed.repartition(F.xxhash64("asin", "updated_at", "title"))
    return first_per_key(dealt, ["asin"], order)


def _unique_reviews(raw: DataFrame, ingest_dt: str, source_system: str) -> DataFrame:
    """One typed record per review key, the one with most votes, with the lengths of its texts.

    What a sort and a shuffle move of a record is the key as text and the columns that are asked for in the end: the id, a digest
    that does not compress, the maps and the constants are left to the records that stay.
    """
    require_columns(raw, RAW_REVIEW_COLUMNS)
    types = {f.name: f.dataType for f in raw.schema}
    asin = blank_to_null(F.col("asin"))
    reviewer = blank_to_null(F.col("reviewerID"))
    rating = F.col("overall").try_cast("double")
    votes = parse.parse_vote(F.col("vote")) if "vote" in types else F.lit(None).cast("int")

    def style(of: str) -> Column:
        return parse.string_map(F.col(of), types["style"]) if "style" in types else parse.empty_map()

    typed = raw.select(
        parse.review_key_text(asin, reviewer, F.col("unixReviewTime"), rating).alias(_KEY),
        asin.alias("asin"),
        reviewer.alias("reviewer_id"),
        F.col("unixReviewTime").alias("unix_time"),
        rating.alias("rating"),
        votes.alias("vote_count"),
        blank_to_null(F.col("reviewText")).alias("review_text"),
        blank_to_null(F.col("summary")).alias("summary"),
        parse.parse_review_date(F.col("reviewTime")).alias("review_time"),
        parse.parse_flag(F.col("verified")).alias("verified"),
        style("style").alias("style"),
        *[F.col(name).alias(_STYLE) for name in ("style",) if name in types],
    )
    lengths = {f"{name}_length": text_length(F.col(name)) for name in ("review_text", "summary")}
    # All rows of one key share product, reviewer, time and rating.
    settled = [_KEY, "asin", "reviewer_id", "unix_time", "rating", "vote_count", _STYLE]
    order = newest("vote_count") + digest_order(typed, settled)
    once = first_per_key(typed.withColumns(lengths), [_KEY], order)
    return once.withColumns({
        "review_id": F.sha2(_KEY, 256),
        "review_timestamp": parse.epoch_to_timestamp(F.col("unix_time")),
        "unix_time": F.col("unix_time").cast("string"),
        "style": style(_STYLE),
        "ingest_dt": _batch_date(ingest_dt),
        "source_system": F.lit(source_system),
    })


def reviews(raw: DataFrame, ingest_dt: str, source_system: str = REVIEW_SOURCE) -> DataFrame:
    """Staging reviews: one row per review key, the one with most votes.

    The key holds product, reviewer, time and rating, so reviews that differ in text only are one review.
    """
    return _unique_reviews(raw, ingest_dt, source_system).select(*REVIEW_COLUMNS)


def review_facts(raw: DataFrame, ingest_dt: str) -> DataFrame:
    """What the feature tables need of :func:`reviews`, with no text moved to find it and the id in its parts."""
    return _unique_reviews(raw, ingest_dt, REVIEW_SOURCE).select(*KEYED_FACTS)
