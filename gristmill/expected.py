"""The same results as plain SQL over the sample tables, for DuckDB.

Written against the sample tables alone, so that a query and its SQL can disagree. Shared steps are common
table expressions; :func:`_with` adds the ones a statement needs.
"""

from __future__ import annotations

from gristmill.operators import quality as q
from gristmill.plans import suites
from gristmill.registry import CURSOR_START, EARLIER, FAILING_SUITE, INGEST_DT, LATER, NOW, RUN_DATE, SAMPLE_DIM

# Fixed value: the white space class in RE2 notation.
SPACES = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _squeeze(expr: str) -> str:
    return f"nullif(trim(regexp_replace({expr}, '{SPACES}', ' ', 'g'), ' '), '')"


def _decode(expr: str) -> str:
    out = expr
    # These entities count with and without the semicolon; the ampersand itself comes last.
    for entity, char in (("&quot", '"'), ("&copy", "©"), ("&middot", "·"), ("&amp", "&")):
        out = f"regexp_replace({out}, '{entity};?', '{char}', 'g')"
    return out


def _blank(expr: str) -> str:
    return f"nullif(trim({expr}, ' '), '')"


_PRICE = r"TRY_CAST(nullif(regexp_extract(price_raw, '(\d+(?:\.\d+)?)', 1), '') AS DOUBLE)"
_DATE = r"TRY_CAST(try_strptime(regexp_extract({0}, '^\s*(\d{{1,2}} \d{{1,2}}, \d{{4}})', 1), '%m %d, %Y') AS DATE)"
_VOTE = "TRY_CAST(nullif(replace(vote, ',', ''), '') AS INTEGER)"


def _joined(array: str) -> str:
    """Text of an array with a marker for null elements."""
    return f"array_to_string(list_transform({array}, lambda x: coalesce(CAST(x AS VARCHAR), '<null>')), '|')"


def _scaled(array: str) -> str:
    return f"array_to_string(list_transform({array}, lambda x: CAST(round(CAST(x AS DOUBLE) * 1e6) AS BIGINT)), ',')"


_STYLE = "concat_ws(',', 'flag=' || style_flag, 'status=' || style_status)"

_CTES: dict[str, str] = {
    "raw_products": """
SELECT CASE WHEN p_partkey % 97 = 0 THEN 'D' ELSE '0' END || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin,
       '  ' || p_name || ' &amp; more ' || CASE WHEN version = 1 THEN '&quot;new&quot;' ELSE '' END AS title,
       CASE p_partkey % 10 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE p_brand END AS brand,
       p_type AS main_cat,
       CASE WHEN p_size > 1 THEN [p_type, p_brand] END AS category,
       CASE WHEN p_size > 8 THEN [p_name, CASE WHEN p_size % 2 = 1 THEN p_brand END, p_type]
            WHEN p_size > 5 THEN CAST([] AS VARCHAR[]) END AS description,
       [p_size, version] AS feature,
       CASE WHEN p_size <= 40 THEN '#' || p_size || ' in ' || p_type END AS rank,
       string_split(p_name, ' ') AS also_buy,
       ' size ' || p_size AS date_raw,
       CASE WHEN p_partkey % 5 < 3 THEN NULL WHEN p_partkey % 50 = 3 THEN ''
            WHEN p_partkey % 50 = 4 THEN '$1,' || p_retailprice ELSE '$' || p_retailprice END AS price_raw,
       '2024-01-0' || (version + 1) || 'T08:00:00' AS updated_at
FROM (SELECT *, unnest(CASE WHEN p_size > 25 THEN [0, 1] ELSE [0] END) AS version FROM part)""",
    "raw_reviews": """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, copy) AS _id,
       CAST(1 + (l_orderkey + l_linenumber) % 5 AS DOUBLE) AS overall,
       CASE WHEN copy = 1 THEN '7' WHEN l_quantity > 45 THEN '1,0' || CAST(l_quantity AS INTEGER)
            WHEN l_quantity > 25 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS vote,
       CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS verified,
       month(l_shipdate) || ' ' || day(l_shipdate) || ', ' || year(l_shipdate)
           || CASE WHEN l_linenumber = 6 THEN ' at noon' ELSE '' END AS reviewTime,
       ' U' || o_custkey AS reviewerID,
       '0' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS asin,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 AND l_linestatus = 'F' THEN '  '
            ELSE repeat('Part ' || l_partkey || ' &amp;  fine.' || chr(10), CAST(floor(l_quantity / 10) AS BIGINT) + 1)
            END AS reviewText,
       CASE WHEN l_linestatus = 'O' THEN 'Order ' || l_orderkey || ' &quot;ok&quot;' END AS summary,
       CAST(epoch(l_shipdate) AS BIGINT) AS unixReviewTime,
       CASE WHEN l_linenumber <> 5 AND l_returnflag <> 'N' THEN l_returnflag END AS style_flag,
       CASE WHEN l_linenumber <> 5 THEN l_linestatus END AS style_status
FROM (SELECT *, unnest(CASE WHEN l_returnflag = 'R' THEN [0, 1] ELSE [0] END) AS copy
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "stg_products": f"""
SELECT {_blank('asin')} AS asin, {_blank('title')} AS title, {_blank('brand')} AS brand,
       {_blank('main_cat')} AS main_category, coalesce(category, []) AS categories,
       coalesce(description, []) AS description, feature AS features, also_buy,
       CAST([] AS VARCHAR[]) AS also_view, [rank] AS rank_raw, {_PRICE} AS price,
       CAST(NULL AS VARCHAR) AS similar_item, {_blank('date_raw')} AS date_raw, DATE '{INGEST_DT}' AS ingest_dt,
       CAST(updated_at AS TIMESTAMP) AS updated_at, 'postgres' AS source_system
FROM raw_products QUALIFY row_number() OVER (PARTITION BY asin ORDER BY updated_at DESC) = 1""",
    "stg_reviews": f"""
SELECT * FROM (
  SELECT sha256(concat_ws('||', coalesce(asin, ''), coalesce({_blank('reviewerID')}, ''),
                coalesce(CAST(unixReviewTime AS VARCHAR), ''), coalesce(CAST(overall AS VARCHAR), ''))) AS review_id,
         asin, {_blank('reviewerID')} AS reviewer_id, overall AS rating, {_VOTE} AS vote_count,
         {_blank('reviewText')} AS review_text, {_blank('summary')} AS summary,
         {_DATE.format('reviewTime')} AS review_time,
         make_timestamp(unixReviewTime * 1000000) AS review_timestamp, verified, {_STYLE} AS style,
         DATE '{INGEST_DT}' AS ingest_dt, 'mongodb' AS source_system
  FROM raw_reviews)
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY vote_count DESC NULLS LAST, review_text DESC NULLS LAST,
    summary DESC NULLS LAST, review_time DESC NULLS LAST, verified DESC NULLS LAST, style DESC NULLS LAST) = 1""",
    "product_features": f"""
SELECT asin, {_squeeze(_decode('title'))} AS title, brand, price, brand IS NOT NULL AS has_brand,
       coalesce(price > 0, false) AS has_price,
       CAST(coalesce(length({_squeeze(_decode('title'))}), 0) AS INTEGER) AS title_length,
       CAST(coalesce(list_sum(list_transform(description, lambda x: coalesce(length(x), 0))), 0) AS INTEGER)
           AS description_total_length,
       main_category, DATE '{RUN_DATE}' AS feature_snapshot_date
FROM stg_products""",
    "user_features": f"""
SELECT reviewer_id, count(asin) AS reviews_count, count(DISTINCT asin) AS distinct_products_count,
       avg(rating) AS avg_rating, CAST(min(rating) AS INTEGER) AS min_rating, CAST(max(rating) AS INTEGER) AS max_rating,
       avg(CAST(verified AS INTEGER)) AS verified_reviews_ratio, avg(coalesce(vote_count, 0)) AS avg_vote_count,
       avg(length(coalesce(review_text, ''))) AS avg_review_text_length,
       min(review_timestamp) AS first_review_timestamp, max(review_timestamp) AS last_review_timestamp,
       CAST(floor((epoch(max(review_timestamp)) - epoch(min(review_timestamp))) / 86400) AS INTEGER) AS active_days_span,
       DATE '{RUN_DATE}' AS feature_snapshot_date
FROM stg_reviews GROUP BY reviewer_id""",
    "product_review_stats": f"""
SELECT asin, count(reviewer_id) AS reviews_count, count(DISTINCT reviewer_id) AS distinct_reviewers_count,
       avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0) AS rating_stddev,
       avg(CAST(verified AS INTEGER)) AS verified_reviews_ratio, avg(coalesce(vote_count, 0)) AS avg_vote_count,
       avg(length(coalesce(review_text, ''))) AS avg_review_text_length,
       avg(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS positive_reviews_ratio,
       avg(CASE WHEN rating <= 2 THEN 1 ELSE 0 END) AS negative_reviews_ratio,
       min(review_timestamp) AS first_review_timestamp, max(review_timestamp) AS last_review_timestamp,
       DATE '{RUN_DATE}' AS feature_snapshot_date
FROM (SELECT * FROM stg_reviews
      QUALIFY row_number() OVER (PARTITION BY reviewer_id, asin, review_timestamp ORDER BY review_id) = 1)
GROUP BY asin""",
    "user_product_interactions": f"""
SELECT r.review_id, r.reviewer_id, r.asin, r.rating, r.vote_count, r.verified,
       CAST(length(coalesce(r.review_text, '')) AS INTEGER) AS review_text_length,
       CAST(length(coalesce(r.summary, '')) AS INTEGER) AS summary_length, r.review_timestamp,
       CAST(r.review_timestamp AS DATE) AS review_date,
       p.main_category AS product_main_category, p.brand AS product_brand, p.price AS product_price,
       CASE WHEN p.asin IS NOT NULL THEN p.description_total_length > 0 END AS product_has_description,
       p.title_length AS product_title_length, p.description_total_length AS product_description_length,
       u.reviews_count AS user_reviews_count, u.avg_rating AS user_avg_rating,
       u.verified_reviews_ratio AS user_verified_reviews_ratio, u.active_days_span AS user_active_days_span,
       s.reviews_count AS product_reviews_count, s.avg_rating AS product_avg_rating,
       s.positive_reviews_ratio AS product_positive_reviews_ratio,
       s.negative_reviews_ratio AS product_negative_reviews_ratio,
       r.rating AS label, DATE '{RUN_DATE}' AS feature_snapshot_date
FROM stg_reviews r LEFT JOIN product_features p ON r.asin = p.asin
LEFT JOIN user_features u ON r.reviewer_id = u.reviewer_id
LEFT JOIN product_review_stats s ON r.asin = s.asin""",
    "landing": """
SELECT CASE WHEN event_type = 'error' THEN substr(line, 1, length(line) - 1) ELSE line END AS line FROM (
  SELECT event_type, '{"asin":"' || CASE WHEN event_type = 'view' THEN '' ELSE 'A' || user_id END || '","title":"'
         || event_type || '","price":"' || event_id || '","category":["' || event_type || '","all"],"rank":"'
         || user_id || '","props":' || props || '}' AS line FROM events)""",
    "documents_landed": """
SELECT line, j->>'$.asin' AS asin, j->>'$.title' AS title, j->>'$.price' AS price, j->>'$.rank' AS rank,
       CAST(j->'$.props' AS VARCHAR) AS props, CAST(j->'$.category' AS VARCHAR[]) AS category
FROM (SELECT line, CASE WHEN json_valid(line) THEN CAST(line AS JSON) END AS j FROM landing)
WHERE coalesce(j->>'$.asin', '') <> ''""",
    "products_landed": """
SELECT * FROM documents_landed
QUALIFY row_number() OVER (PARTITION BY asin ORDER BY length(line) DESC, line DESC) = 1""",
    "stored_vectors": """
SELECT 'R' || vec_id AS review_id, 'A' || label AS asin, 'U' || vec_id AS reviewer_id,
       make_timestamp((1600000000 + vec_id * 60) * 1000000) AS review_timestamp, sha256('text ' || vec_id) AS text_hash,
       'model-1' AS model_version, embedding, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM embeddings""",
    "vector_batch": """
SELECT CASE WHEN label = 0 THEN 'N' ELSE 'R' END || vec_id AS review_id, 'B' || label AS asin,
       'U' || vec_id AS reviewer_id, make_timestamp((1700000000 + vec_id * 60) * 1000000) AS review_timestamp,
       sha256(CASE WHEN label IN (1, 2) THEN 'new text ' ELSE 'text ' END || vec_id) AS text_hash,
       CASE WHEN label = 3 THEN 'model-2' ELSE 'model-1' END AS model_version,
       list_transform(embedding, lambda x: -x) AS embedding
FROM embeddings""",
    "damaged_vectors": """
SELECT CASE WHEN asin = 'A4' THEN 'R-same' ELSE review_id END AS review_id,
       CASE asin WHEN 'A1' THEN NULL WHEN 'A2' THEN embedding[1:10] ELSE embedding END AS embedding, model_version,
       CASE WHEN asin <> 'A3' THEN text_hash END AS text_hash
FROM stored_vectors""",
    "document_texts": f"""
SELECT * FROM (
  SELECT 'D' || doc_id AS review_id, source AS asin, lang AS reviewer_id,
         make_timestamp((1600000000 + doc_id) * 1000000) AS review_timestamp, DATE '{INGEST_DT}' AS ingest_dt,
         nullif(concat_ws('. ', CASE WHEN lang = 'de' OR source = 'src1' THEN NULL ELSE 'From "' || source || '"' END,
                          {_squeeze('text')}), '') AS text_for_embedding
  FROM documents)
WHERE text_for_embedding IS NOT NULL""",
    "prepared": """
SELECT *, sha256(text_for_embedding) AS text_hash, 'hashed-64' AS model_version FROM document_texts""",
    "mixed_ratings": """
SELECT TRY_CAST(CASE WHEN reviewText IS NULL THEN 'n/a' ELSE CAST(overall AS VARCHAR) END AS DOUBLE) AS overall
FROM raw_reviews""",
    "orders_by_year": """
SELECT *, CAST(date_trunc('year', o_orderdate) AS DATE) AS ingest_dt FROM orders""",
}

_NEEDS: dict[str, tuple[str, ...]] = {
    "stg_products": ("raw_products",),
    "stg_reviews": ("raw_reviews",),
    "product_features": ("stg_products",),
    "user_features": ("stg_reviews",),
    "product_review_stats": ("stg_reviews",),
    "user_product_interactions": ("product_features", "user_features", "product_review_stats"),
    "documents_landed": ("landing",),
    "products_landed": ("documents_landed",),
    "damaged_vectors": ("stored_vectors",),
    "prepared": ("document_texts",),
    "mixed_ratings": ("raw_reviews",),
}


def _with(body: str, *tables: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in tables:
        add(name)
    ctes = ", ".join(f"{name} AS MATERIALIZED ({_CTES[name]})" for name in order)
    return f"WITH {ctes} {body}" if ctes else body


def _round(*names: str) -> str:
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


def _suite_sql(table: str, suite: tuple[q.Check, ...], types: dict[str, str]) -> str:
    """One SELECT per check. ``types`` names the columns' Spark types."""
    rows = []
    for position, check in enumerate(suite):
        values = dict.fromkeys(
            "element_count missing_count missing_percent unexpected_count unexpected_percent "
            "unexpected_percent_total unexpected_percent_nonmissing observed_value".split(),
            "NULL",
        )
        column, source = check.column, f"FROM {table}"
        total, nulls = "count(*)", f"count(*) - count({column})"
        if check.expectation == q.EXISTS:
            success, source = str(column in types).lower(), ""
        elif check.expectation in (q.OF_TYPE, q.IN_TYPE_LIST):
            wanted = [q.TYPE_NAMES[name] for name in check.allowed]
            success, source = str(types[column] in wanted).lower(), ""
            values["observed_value"] = f"'{types[column]}'"
        elif column not in types:
            success, source = "false", ""
        elif check.expectation == q.NON_NULL_SHARE:
            success = f"count({column}) / count(*) BETWEEN {check.low} AND {check.high}"
            values["observed_value"] = f"CAST(round(count({column}) / count(*), 6) AS VARCHAR)"
        else:
            if check.expectation == q.NOT_NULL:
                bad, base = nulls, total
            elif check.expectation == q.UNIQUE:
                source = (
                    f"FROM (SELECT {column}, {column} IS NOT NULL AND count(*) OVER (PARTITION BY {column}) > 1 AS bad "
                    f"FROM {table})"
                )
                bad, base = "count(*) FILTER (WHERE bad)", f"count({column})"
            else:
                conditions = []
                if check.expectation == q.IN_SET:
                    conditions.append(f"{column} NOT IN ({', '.join(_literal(v) for v in check.allowed)})")
                if check.low is not None:
                    conditions.append(f"{column} < {check.low}")
                if check.high is not None:
                    conditions.append(f"{column} > {check.high}")
                bad, base = f"count(*) FILTER (WHERE {' OR '.join(conditions)})", f"count({column})"
            success = f"({base}) - ({bad}) >= ({base}) * CAST({check.mostly} AS DOUBLE)"
            values["element_count"], values["unexpected_count"] = total, bad
            values["unexpected_percent"] = _share(bad, base)
            if check.expectation != q.NOT_NULL:
                values["missing_count"], values["missing_percent"] = nulls, _share(nulls, total)
                values["unexpected_percent_total"] = _share(bad, total)
                values["unexpected_percent_nonmissing"] = _share(bad, base)
        kinds = {"observed_value": "VARCHAR"}
        measured = ", ".join(
            f"CAST({sql} AS {kinds.get(name, 'BIGINT' if name.endswith('count') else 'DOUBLE')}) AS {name}"
            for name, sql in values.items()
        )
        rows.append(
            f"SELECT CAST({position} AS INTEGER) AS position, '{check.expectation}' AS expectation, "
            f"'{column}' AS column, '{check.severity}' AS severity, {success} AS success, {measured} {source}"
        )
    return " UNION ALL ".join(rows)


def _literal(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else f"'{value}'"


def _share(part: str, whole: str) -> str:
    return f"round(CASE WHEN ({whole}) > 0 THEN ({part}) * CAST(100 AS DOUBLE) / ({whole}) ELSE 0 END, 6)"


# Spark types of the columns a type check looks at; other columns only need to be present.
_TYPES = {
    "stg_products": {c: "" for c in "asin title categories also_buy also_view".split()} | {"price": "double"},
    "stg_reviews": {c: "" for c in "asin reviewer_id review_id rating review_time".split()} | {"review_text": "string"},
    "raw_reviews": {c: "" for c in "verified summary reviewText unixReviewTime".split()}
    | {"overall": "double", "vote": "string"},
}


# The columns of the feature tables.
_FEATURE_COLUMNS = {
    "product_features": (
        "asin",
        "title",
        "brand",
        "price",
        "has_brand",
        "has_price",
        "title_length",
        "description_total_length",
        "main_category",
        "feature_snapshot_date",
    ),
    "user_features": (
        "reviewer_id",
        "reviews_count",
        "distinct_products_count",
        "avg_rating",
        "min_rating",
        "max_rating",
        "verified_reviews_ratio",
        "avg_vote_count",
        "avg_review_text_length",
        "first_review_timestamp",
        "last_review_timestamp",
        "active_days_span",
        "feature_snapshot_date",
    ),
    "product_review_stats": (
        "asin",
        "reviews_count",
        "distinct_reviewers_count",
        "avg_rating",
        "rating_stddev",
        "verified_reviews_ratio",
        "avg_vote_count",
        "avg_review_text_length",
        "positive_reviews_ratio",
        "negative_reviews_ratio",
        "first_review_timestamp",
        "last_review_timestamp",
        "feature_snapshot_date",
    ),
    "user_product_interactions": (
        "review_id",
        "reviewer_id",
        "asin",
        "rating",
        "vote_count",
        "verified",
        "review_text_length",
        "summary_length",
        "review_timestamp",
        "review_date",
        "product_main_category",
        "product_brand",
        "product_price",
        "product_has_description",
        "product_title_length",
        "product_description_length",
        "user_reviews_count",
        "user_avg_rating",
        "user_verified_reviews_ratio",
        "user_active_days_span",
        "product_reviews_count",
        "product_avg_rating",
        "product_positive_reviews_ratio",
        "product_negative_reviews_ratio",
        "label",
        "feature_snapshot_date",
    ),
}


def _suite(table: str, suite: tuple[q.Check, ...]) -> str:
    types = _TYPES.get(table) or dict.fromkeys(_FEATURE_COLUMNS[table], "")
    return _with(_suite_sql(table, suite, types), table)


_REVIEW_RATIOS = ("avg_rating", "verified_reviews_ratio", "avg_vote_count", "avg_review_text_length")
_DOUBLES = {
    "product_features": ("price",),
    "user_features": _REVIEW_RATIOS,
    "product_review_stats": (*_REVIEW_RATIOS, "rating_stddev", "positive_reviews_ratio", "negative_reviews_ratio"),
    "user_product_interactions": (
        "product_price",
        "user_avg_rating",
        "user_verified_reviews_ratio",
        "product_avg_rating",
        "product_positive_reviews_ratio",
        "product_negative_reviews_ratio",
    ),
}


def _feature(table: str) -> str:
    return _with(f"SELECT * REPLACE ({_round(*_DOUBLES[table])}) FROM {table}", table)


def _counts(*tables: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables)


_FEATURES = ("product_features", "user_features", "product_review_stats", "user_product_interactions")
_PRODUCT_ARRAYS = ("categories", "description", "features", "also_buy", "also_view", "rank_raw")

_TOKENS = f"""
tokens AS (SELECT review_id, unnest(string_split(text_for_embedding, ' ')) AS token FROM prepared),
slots AS (SELECT review_id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {SAMPLE_DIM} AS slot, count(*) AS n
          FROM tokens WHERE token <> '' GROUP BY ALL),
norms AS (SELECT review_id, CAST(sqrt(sum(n * n)) AS FLOAT) AS norm FROM slots GROUP BY review_id),
filled AS (SELECT p.review_id, p.text_hash, p.model_version, g.slot, coalesce(s.n, 0) AS n, norm
           FROM prepared p JOIN norms USING (review_id) CROSS JOIN (SELECT range AS slot FROM range({SAMPLE_DIM})) g
           LEFT JOIN slots s ON s.review_id = p.review_id AND s.slot = g.slot)"""


def _embedded(body: str) -> str:
    """A statement over ``embedded``: the prepared documents with their vectors as text."""
    vector = (
        "string_agg(CAST(CAST(round(CAST(CAST(n AS FLOAT) / norm AS DOUBLE) * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY slot)"
    )
    vectors = f"SELECT review_id, text_hash, model_version, {vector} AS embedding FROM filled GROUP BY ALL"
    named = f"SELECT v.*, p.reviewer_id FROM ({vectors}) v JOIN prepared p USING (review_id)"
    return _with("", "prepared") + f", {_TOKENS}, embedded AS ({named}) {body}"


def oracle_sql() -> dict[str, str]:
    unit = f"list_transform(scaled, lambda x: CAST(x / norm AS FLOAT))"
    return {
        "staging_products": _with(
            "SELECT * REPLACE (round(price, 6) AS price, "
            + ", ".join(f"{_joined(name)} AS {name}" for name in _PRODUCT_ARRAYS)
            + ") FROM stg_products",
            "stg_products",
        ),
        "staging_reviews": _with("SELECT * FROM stg_reviews", "stg_reviews"),
        **{name: _feature(name) for name in _FEATURES},
        "interactions_of_repeated_reviews": _feature("user_product_interactions"),
        "user_features_incremental": _feature("user_features"),
        "product_stats_incremental": _feature("product_review_stats"),
        "refresh_row_counts": _with(
            _counts(*_FEATURES)
            + " UNION ALL SELECT 'review_embeddings', count(*) FROM stg_reviews "
            + f"WHERE {_squeeze(_decode('summary'))} IS NOT NULL OR {_squeeze(_decode('review_text'))} IS NOT NULL",
            *_FEATURES,
        ),
        "incremental_refresh": _with(
            "SELECT *, (SELECT count(*) FROM raw_reviews) AS records_taken, CAST(0 AS BIGINT) AS records_of_third_run "
            "FROM stg_reviews",
            "stg_reviews",
        ),
        "normalize_strings": _with(
            f"SELECT asin, updated_at, {_blank('title')} AS title, {_blank('brand')} AS brand, "
            f"{_blank('date_raw')} AS date_raw FROM raw_products",
            "raw_products",
        ),
        "parse_price": _with(
            f"SELECT asin, updated_at, price_raw, round({_PRICE}, 6) AS price FROM raw_products", "raw_products"
        ),
        "extract_price": _with(
            f"SELECT asin, updated_at, round({_PRICE}, 6) AS from_raw, round({_PRICE} * 2, 6) AS from_typed, "
            "CAST(NULL AS DOUBLE) AS from_nothing FROM raw_products",
            "raw_products",
        ),
        "parse_vote": _with(f"SELECT _id, vote, {_VOTE} AS vote_count FROM raw_reviews", "raw_reviews"),
        "parse_review_date": _with(
            f"SELECT _id, reviewTime, CASE WHEN vote IS NOT NULL THEN {_DATE.format('reviewTime')} END AS review_time "
            "FROM raw_reviews",
            "raw_reviews",
        ),
        "unix_to_timestamp": _with(
            "SELECT _id, make_timestamp(unixReviewTime * 1000000) AS review_timestamp FROM raw_reviews", "raw_reviews"
        ),
        "review_id_hash": _with(
            "SELECT _id, sha256(asin || '||' || reviewerID || '||' || unixReviewTime || '||' "
            "|| CASE WHEN verified IS NOT NULL THEN CAST(overall AS VARCHAR) ELSE '' END) AS review_id FROM raw_reviews",
            "raw_reviews",
        ),
        "optional_columns": _with(
            "SELECT review_id, CAST(NULL AS INTEGER) AS vote_count, '' AS style FROM stg_reviews", "stg_reviews"
        ),
        "normalize_arrays": _with(
            "SELECT asin, updated_at, "
            + ", ".join(
                f"coalesce({_joined(name)}, '') AS {name}" for name in ("category", "description", "feature", "also_buy")
            )
            + ", coalesce(rank, '<null>') AS rank, '' AS also_view FROM raw_products",
            "raw_products",
        ),
        "array_total_length": _with(
            "SELECT asin, updated_at, "
            + ", ".join(
                f"CAST(coalesce(list_sum(list_transform({name}, lambda x: coalesce(length(x), 0))), 0) AS INTEGER) "
                f"AS {name}_length"
                for name in ("category", "description")
            )
            + ", CAST(0 AS INTEGER) AS rank_length FROM raw_products",
            "raw_products",
        ),
        "struct_to_map": _with(f"SELECT _id, {_STYLE} AS style FROM raw_reviews", "raw_reviews"),
        "clean_text": f"SELECT page_id, {_squeeze(_decode('html'))} AS cleaned FROM pages",
        "safe_json_ingest": _with("SELECT asin, title, price, props FROM documents_landed", "documents_landed"),
        "json_project": _with(
            "SELECT asin, title, price AS price_raw, array_to_string(category, '|') AS category, rank, "
            + ", ".join(
                f"CAST(NULL AS VARCHAR) AS {name}"
                for name in "brand main_cat similar_item tech1 tech2 fit date_raw description feature also_buy also_view "
                "image_url image_url_high_res".split()
            )
            + " FROM products_landed",
            "products_landed",
        ),
        "distinct_on_longest": _with("SELECT asin, line FROM products_landed", "products_landed"),
        "dedup_latest_by_key": (
            "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
            "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, "
            "l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"
        ),
        "null_key_guard": _with(
            f"SELECT count(*) AS total_rows, count(*) - count({_blank('asin')}) AS null_asin_count, "
            f"count(*) - count({_blank('brand')}) AS null_brand_count, "
            "count(*) - count(TRY_CAST(updated_at AS TIMESTAMP)) AS null_updated_at_count FROM raw_products",
            "raw_products",
        ),
        "key_null_counts": _with(
            "SELECT count(*) AS total_rows, count(*) - count(asin) AS null_asin_count FROM product_features",
            "product_features",
        ),
        "load_counts": _with(
            "SELECT count(*) AS row_count, count(DISTINCT asin) AS distinct_keys FROM raw_products", "raw_products"
        ),
        "profile_rating_stats": _with(
            "SELECT round(avg(overall), 6) AS avg_rating, min(overall) AS min_rating, max(overall) AS max_rating, "
            "count(*) AS total_reviews FROM mixed_ratings WHERE overall IS NOT NULL",
            "mixed_ratings",
        ),
        "profile_rating_distribution": _with(
            "SELECT overall AS rating, count(*) AS count FROM mixed_ratings WHERE overall IS NOT NULL "
            "GROUP BY overall ORDER BY overall DESC",
            "mixed_ratings",
        ),
        "profile_text_length": _with(
            "SELECT round(avg(length(coalesce(reviewText, ''))), 6) AS avg_length, "
            "CAST(max(length(coalesce(reviewText, ''))) AS INTEGER) AS max_length FROM raw_reviews",
            "raw_reviews",
        ),
        "profile_freshness": _with(
            "SELECT make_timestamp(max(unixReviewTime) * 1000000) AS newest, "
            "make_timestamp(min(unixReviewTime) * 1000000) AS oldest, count(*) FILTER "
            "(WHERE unixReviewTime >= epoch(TIMESTAMP '2001-11-04 00:00:00') - 365 * 86400) AS reviews_in_last_year "
            "FROM raw_reviews",
            "raw_reviews",
        ),
        "table_row_counts": _with(_counts(*_FEATURES), *_FEATURES),
        "embedding_text": _with("SELECT * FROM prepared", "prepared"),
        "embed_documents": _embedded("SELECT review_id, text_hash, model_version, embedding FROM embedded"),
        "embedding_incremental": _with(
            "SELECT p.review_id, text_hash, model_version FROM prepared p WHERE review_id NOT IN "
            "(SELECT 'D' || doc_id FROM labels WHERE toxic <> 1)",
            "prepared",
        ),
        "l2_normalize": f"""
            SELECT vec_id, {_scaled(unit)} AS unit FROM (
              SELECT vec_id, scaled, CASE WHEN norm = 0 THEN CAST(1 AS FLOAT) ELSE norm END AS norm FROM (
                SELECT vec_id, scaled, CAST(sqrt(list_sum(list_transform(scaled,
                       lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS FLOAT) AS norm FROM (
                  SELECT vec_id, list_transform(embedding, lambda x: x * CAST(CASE label WHEN 0 THEN 0 WHEN 1 THEN 3
                         ELSE 1 END AS FLOAT)) AS scaled FROM embeddings)))""",
        "vector_literal": f"SELECT vec_id, {_scaled('embedding')} AS components, true AS bracketed FROM embeddings",
        "vector_table_counts": _with(
            "SELECT count(*) AS embeddings_count, count(DISTINCT review_id) AS distinct_reviews, "
            "count(DISTINCT asin) AS distinct_products, count(DISTINCT model_version) AS model_versions "
            "FROM stored_vectors",
            "stored_vectors",
        ),
        "vector_dim_histogram": _with(
            "SELECT CAST(len(embedding) AS INTEGER) AS embedding_dimension, count(*) AS row_count "
            "FROM damaged_vectors GROUP BY 1",
            "damaged_vectors",
        ),
        "vector_table_checks": _with(
            f"""
            SELECT 'table_not_empty' AS check_name, count(*) AS metric_value, 'count > 0' AS expected_condition,
                   count(*) > 0 AS passed FROM damaged_vectors
            UNION ALL SELECT 'no_nulls_in_required_columns', count(*), 'count = 0', count(*) = 0 FROM damaged_vectors
            WHERE review_id IS NULL OR embedding IS NULL OR model_version IS NULL OR text_hash IS NULL
            UNION ALL SELECT 'no_duplicate_review_id', count(*), 'count = 0', count(*) = 0
            FROM (SELECT review_id FROM damaged_vectors GROUP BY review_id HAVING count(*) > 1)
            UNION ALL SELECT 'all_embeddings_have_expected_dimension', count(*),
                   'count = 0 for vector_dims(embedding) != {SAMPLE_DIM}', count(*) = 0
            FROM damaged_vectors WHERE len(embedding) <> {SAMPLE_DIM}""",
            "damaged_vectors",
        ),
        "vector_preview": _with(
            "SELECT review_id, asin, model_version, text_hash, created_at FROM stored_vectors ORDER BY review_id LIMIT 10",
            "stored_vectors",
        ),
        "cosine_topk": f"""
            WITH parts AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
                           FROM embeddings),
            centers AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM parts GROUP BY ALL),
            center_norms AS (SELECT label, sqrt(sum(c * c)) AS cn FROM centers GROUP BY label),
            norms AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * x)) AS n FROM parts GROUP BY vec_id),
            dots AS (SELECT c.label, p.vec_id, sum(CAST(p.x AS DOUBLE) * c.c) AS dot
                     FROM parts p JOIN centers c USING (i) GROUP BY ALL),
            scored AS (SELECT CAST(label AS VARCHAR) AS query, vec_id, round(dot / (cn * n), 6) AS score
                       FROM dots JOIN center_norms USING (label) JOIN norms USING (vec_id))
            SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score FROM scored QUALIFY rank <= 10""",
        "cosine_topk_all": """
            WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
            unit AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v),
            best AS (SELECT q.vec_id AS query, v.vec_id, list_dot_product(q.e, v.e) AS score FROM unit q, unit v
                     QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round(score, 12) DESC, v.vec_id) <= 10)
            SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY round(score, 6) DESC, vec_id) AS INTEGER)
                   AS rank, vec_id, round(score, 6) AS score FROM best""",
        "embedding_upsert": _with(
            f"""
            SELECT coalesce(s.review_id, b.review_id) AS review_id,
                   CASE WHEN take THEN b.asin ELSE s.asin END AS asin,
                   CASE WHEN take THEN b.reviewer_id ELSE s.reviewer_id END AS reviewer_id,
                   CASE WHEN take THEN b.review_timestamp ELSE s.review_timestamp END AS review_timestamp,
                   CASE WHEN take THEN b.text_hash ELSE s.text_hash END AS text_hash,
                   CASE WHEN take THEN b.model_version ELSE s.model_version END AS model_version,
                   coalesce(s.created_at, TIMESTAMP '{NOW}') AS created_at,
                   CASE WHEN take THEN TIMESTAMP '{NOW}' ELSE s.updated_at END AS updated_at,
                   {_scaled('CASE WHEN take THEN b.embedding ELSE s.embedding END')} AS components
            FROM (SELECT s, b, b.review_id IS NOT NULL AND (s.review_id IS NULL
                         OR s.text_hash IS DISTINCT FROM b.text_hash
                         OR s.model_version IS DISTINCT FROM b.model_version) AS take
                  FROM stored_vectors s FULL JOIN vector_batch b ON s.review_id = b.review_id)""",
            "stored_vectors",
            "vector_batch",
        ),
        "vector_refresh_rerun": _embedded(
            f"""
            SELECT review_id, text_hash, model_version, embedding, CAST(2 AS BIGINT) AS versions_written,
                   CASE WHEN reviewer_id = 'en' THEN TIMESTAMP '{EARLIER}' ELSE TIMESTAMP '{NOW}' END AS created_at,
                   CASE WHEN reviewer_id = 'en' THEN TIMESTAMP '{EARLIER}' ELSE TIMESTAMP '{NOW}' END AS updated_at
            FROM embedded"""
        ),
        "vector_refresh_two_writers": _embedded(
            f"""
            SELECT review_id, text_hash, CASE reviewer_id WHEN 'en' THEN 'hashed-64b' ELSE model_version END AS model_version,
                   embedding, CAST(3 AS BIGINT) AS versions_written,
                   CASE reviewer_id WHEN 'de' THEN TIMESTAMP '{EARLIER}' ELSE TIMESTAMP '{NOW}' END AS created_at,
                   CASE reviewer_id WHEN 'de' THEN TIMESTAMP '{EARLIER}' WHEN 'en' THEN TIMESTAMP '{LATER}'
                        ELSE TIMESTAMP '{NOW}' END AS updated_at
            FROM embedded"""
        ),
        "batch_key_check": _with(
            """
            SELECT 'landed' AS step, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
                   count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(0 AS BIGINT) AS null_keys
            FROM (SELECT asin, count(*) AS n FROM documents_landed GROUP BY asin)
            UNION ALL SELECT 'unique', count(DISTINCT asin), count(DISTINCT asin), 0, 0 FROM documents_landed""",
            "documents_landed",
        ),
        "product_upsert": _with(
            f"""
            SELECT coalesce(p.asin, t.asin) AS asin, CASE WHEN p.asin IS NULL THEN t.title ELSE p.title END AS title,
                   CASE WHEN p.asin IS NULL THEN t.brand END AS brand,
                   CASE WHEN p.asin IS NULL THEN '1' ELSE p.price END AS price_raw,
                   CASE WHEN p.asin IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS ingest_dt,
                   CASE WHEN p.asin IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '{NOW}' END AS updated_at
            FROM (SELECT 'A' || (c_custkey + 20) AS asin, c_name AS title, c_mktsegment AS brand FROM customer) t
            FULL JOIN products_landed p ON t.asin = p.asin""",
            "products_landed",
        ),
        "stats_merge": _with(
            f"""
            SELECT o_orderpriority AS _id, round(avg(o_totalprice), 6) AS avg_rating, count(*) AS total_reviews,
                   CAST(1704067200 AS BIGINT) AS last_updated FROM orders GROUP BY o_orderpriority
            UNION ALL SELECT 'global_stats', round(avg(overall), 6), count(*), CAST(epoch(TIMESTAMP '{NOW}') AS BIGINT)
            FROM mixed_ratings WHERE overall IS NOT NULL""",
            "mixed_ratings",
        ),
        "dq_suite_products": _suite("stg_products", suites.STAGING_PRODUCTS),
        "dq_suite_reviews": _suite("stg_reviews", suites.STAGING_REVIEWS),
        "dq_suite_product_features": _suite("product_features", suites.PRODUCT_FEATURES),
        "dq_suite_user_features": _suite("user_features", suites.USER_FEATURES),
        "dq_suite_review_stats": _suite("product_review_stats", suites.PRODUCT_REVIEW_STATS),
        "dq_suite_interactions": _suite("user_product_interactions", suites.USER_PRODUCT_INTERACTIONS),
        "dq_failing_suite": _suite("raw_reviews", FAILING_SUITE),
        "dq_unexpected_sample": _with(
            "SELECT vote_count FROM stg_reviews WHERE vote_count < 0 OR vote_count > 40 ORDER BY vote_count LIMIT 20",
            "stg_reviews",
        ),
        "raw_scan_manifest": "SELECT * FROM events",
        "raw_sink_counts": "SELECT CAST(count(*) AS BIGINT) AS records, true AS within_limit FROM events",
        "manifest_build": f"""
            SELECT '1.0' AS manifest_version, 'events' AS source_name, '{INGEST_DT}' AS ingest_dt,
                   '2024-01-01T00:00:00Z' AS extract_ts_utc, 'one_shot' AS mode,
                   'raw/events/ingest_dt={INGEST_DT}/' AS prefix, 'jsonl.gz' AS format, count(*) AS records,
                   true AS all_files_listed, false AS incremental_enabled, 'ts' AS cursor_field,
                   CAST(NULL AS VARCHAR) AS watermark_in, max(ts) AS watermark_out FROM events""",
        "reconcile_counts": "SELECT count(*) AS source_records, count(*) AS written_records, true AS lines_match, "
        "true AS matches, CAST(0 AS BIGINT) AS changed_files FROM events",
        "partition_scan": _with("SELECT * FROM orders_by_year WHERE ingest_dt = DATE '1997-01-01'", "orders_by_year"),
        "dynamic_overwrite": _with(
            "SELECT * REPLACE (round(CASE WHEN ingest_dt >= DATE '1998-01-01' THEN o_totalprice * 2 ELSE o_totalprice END, "
            "6) AS o_totalprice) FROM orders_by_year",
            "orders_by_year",
        ),
        "table_replace": "SELECT * REPLACE (round(o_totalprice * 2, 6) AS o_totalprice) FROM orders",
        "incremental_extract": f"SELECT * FROM events WHERE ts > TIMESTAMP '{CURSOR_START}'",
        "watermark_advance": "SELECT CAST(0 AS BIGINT) AS rows_left, max(ts) AS watermark FROM events",
        "incremental_boundary": """
            SELECT event_id, CAST(CASE WHEN day > DATE '2024-01-20' THEN 4 WHEN event_id % 3 <> 0 THEN 1 ELSE 2 END AS BIGINT) AS run
            FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
            WHERE day > DATE '2024-01-20' OR event_id % 3 <> 0 OR event_type = 'error' OR day >= DATE '2024-01-15'""",
        "versions_retained": """
            SELECT o_orderpriority, count(*) AS row_count, CAST(4 AS BIGINT) AS folders_removed, '5,6' AS versions_kept
            FROM orders GROUP BY o_orderpriority""",
    }
