"""The six quality suites, one per table. The checks and their bounds are fixed values."""

from __future__ import annotations

from gristmill.operators.quality import (
    between,
    exists,
    flatten,
    in_set,
    in_type_list,
    non_null_share,
    not_null,
    of_type,
    unique,
)

STAGING_PRODUCTS = flatten(
    [
        not_null("asin"),
        unique("asin"),
        non_null_share("title", 0.95, 1.0),
        of_type("price", "float64"),
        exists("categories", "also_buy", "also_view"),
        not_null("categories", mostly=0.8, severity="warning"),
    ]
)

STAGING_REVIEWS = flatten(
    [
        not_null("asin"),
        not_null("reviewer_id"),
        unique("review_id"),
        between("rating", 1.0, 5.0),
        not_null("review_time"),
        in_type_list("review_text", "str", "string"),
    ]
)

PRODUCT_FEATURES = flatten(
    [
        not_null("asin"),
        unique("asin"),
        exists("title", "brand", "main_category", "price", "has_brand", "has_price"),
        exists("title_length", "description_total_length", "feature_snapshot_date"),
        not_null("feature_snapshot_date"),
        between("title_length", 0),
        between("description_total_length", 0),
        between("price", 0, mostly=0.95, severity="warning"),
        in_set("has_brand", True, False),
        in_set("has_price", True, False),
    ]
)

USER_FEATURES = flatten(
    [
        not_null("reviewer_id"),
        unique("reviewer_id"),
        exists("reviews_count", "distinct_products_count", "avg_rating", "min_rating", "max_rating"),
        exists("verified_reviews_ratio", "avg_vote_count", "avg_review_text_length"),
        exists("first_review_timestamp", "last_review_timestamp", "active_days_span", "feature_snapshot_date"),
        not_null("feature_snapshot_date"),
        not_null("first_review_timestamp"),
        not_null("last_review_timestamp"),
        between("reviews_count", 1),
        between("distinct_products_count", 1),
        between("avg_vote_count", 0),
        between("avg_review_text_length", 0),
        between("active_days_span", 0),
        between("avg_rating", 1, 5),
        between("min_rating", 1, 5),
        between("max_rating", 1, 5),
        between("verified_reviews_ratio", 0, 1),
    ]
)

PRODUCT_REVIEW_STATS = flatten(
    [
        not_null("asin"),
        unique("asin"),
        exists("reviews_count", "distinct_reviewers_count", "avg_rating", "rating_stddev"),
        exists("verified_reviews_ratio", "avg_vote_count", "avg_review_text_length"),
        exists("positive_reviews_ratio", "negative_reviews_ratio"),
        exists("first_review_timestamp", "last_review_timestamp", "feature_snapshot_date"),
        not_null("feature_snapshot_date"),
        not_null("first_review_timestamp"),
        not_null("last_review_timestamp"),
        between("reviews_count", 1),
        between("distinct_reviewers_count", 1),
        between("avg_rating", 1, 5),
        between("rating_stddev", 0),
        between("verified_reviews_ratio", 0, 1),
        between("avg_vote_count", 0),
        between("avg_review_text_length", 0),
        between("positive_reviews_ratio", 0, 1),
        between("negative_reviews_ratio", 0, 1),
    ]
)

USER_PRODUCT_INTERACTIONS = flatten(
    [
        not_null("review_id"),
        unique("review_id"),
        not_null("reviewer_id"),
        not_null("asin"),
        exists("rating", "vote_count", "verified", "review_text_length", "summary_length"),
        exists("review_timestamp", "review_date"),
        exists("product_main_category", "product_brand", "product_price", "product_has_description"),
        exists("product_title_length", "product_description_length"),
        exists("user_reviews_count", "user_avg_rating", "user_verified_reviews_ratio", "user_active_days_span"),
        exists("product_reviews_count", "product_avg_rating"),
        exists("product_positive_reviews_ratio", "product_negative_reviews_ratio"),
        exists("label", "feature_snapshot_date"),
        not_null("review_timestamp"),
        not_null("review_date"),
        not_null("feature_snapshot_date"),
        not_null("label"),
        between("rating", 1, 5),
        between("label", 1, 5),
        between("vote_count", 0),
        between("review_text_length", 0),
        between("summary_length", 0),
        between("product_title_length", 0),
        between("product_description_length", 0),
        between("product_price", 0, mostly=0.95, severity="warning"),
        in_set("product_has_description", True, False),
        between("user_reviews_count", 1),
        between("user_avg_rating", 1, 5),
        between("user_verified_reviews_ratio", 0, 1),
        between("user_active_days_span", 0),
        between("product_reviews_count", 1),
        between("product_avg_rating", 1, 5),
        between("product_positive_reviews_ratio", 0, 1),
        between("product_negative_reviews_ratio", 0, 1),
        in_set("verified", True, False),
    ]
)

BY_TABLE = {
    "staging_products": STAGING_PRODUCTS,
    "staging_reviews": STAGING_REVIEWS,
    "product_features": PRODUCT_FEATURES,
    "user_features": USER_FEATURES,
    "product_review_stats": PRODUCT_REVIEW_STATS,
    "user_product_interactions": USER_PRODUCT_INTERACTIONS,
}
