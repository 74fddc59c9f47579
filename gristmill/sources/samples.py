"""Raw products, raw reviews, landing lines and stored vectors derived from the sample tables.

Every row of the underlying tables is used. The derivations add what real sources have: blanks, nulls, entities,
repeated deliveries, broken lines and products nobody lists any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _asin(key: Column, prefix: Column | None = None) -> Column:
    return F.concat(F.lit("0") if prefix is None else prefix, F.lpad(key.cast("string"), 9, "0"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from ``part``; large parts were delivered twice, some keys carry a delisting prefix."""
    key, size = F.col("p_partkey"), F.col("p_size")
    versions = F.when(size > 25, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    part = table(spark, sf_dir, "part").withColumn("version", F.explode(versions))
    price = F.col("p_retailprice").cast("string")
    return part.select(
        _asin(key, F.when(key % 97 == 0, "D").otherwise("0")).alias("asin"),
        F.concat(
            F.lit("  "),
            F.col("p_name"),
            F.lit(" &amp; more "),
            F.when(F.col("version") == 1, "&quot;new&quot;").otherwise(""),
        ).alias("title"),
        F.when(key % 10 == 0, "  ").when(key % 10 == 1, F.lit(None)).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("main_cat"),
        F.when(size > 1, F.array("p_type", "p_brand")).alias("category"),
        F.when(size > 8, F.array(F.col("p_name"), F.when(size % 2 == 1, F.col("p_brand")), F.col("p_type")))
        .when(size > 5, F.array().cast("array<string>"))
        .alias("description"),
        F.array(size, F.col("version")).alias("feature"),
        F.when(size <= 40, F.concat(F.lit("#"), size.cast("string"), F.lit(" in "), F.col("p_type"))).alias("rank"),
        F.split("p_name", " ").alias("also_buy"),
        F.array().cast("array<string>").alias("also_view"),
        F.lit("").alias("similar_item"),
        F.concat(F.lit(" size "), size.cast("string")).alias("date_raw"),
        F.when(key % 5 < 3, F.lit(None))
        .when(key % 50 == 3, "")
        .when(key % 50 == 4, F.concat(F.lit("$1,"), price))
        .otherwise(F.concat(F.lit("$"), price))
        .alias("price_raw"),
        F.lit("2024-01-01").alias("ingest_dt"),
        F.concat(F.lit("2024-01-0"), (F.col("version") + 1).cast("string"), F.lit("T08:00:00")).alias("updated_at"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews from ``lineitem`` and the ordering customer; returned items were delivered twice."""
    copies = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    lines = lines.withColumn("copy", F.explode(copies))
    quantity = F.col("l_quantity").cast("int").cast("string")
    shipped = F.col("l_shipdate").cast("timestamp")
    number = F.col("l_linenumber")
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey"), number, F.col("l_partkey"), F.col("copy")).alias("_id"),
        (F.lit(1) + (F.col("l_orderkey") + number) % 5).cast("double").alias("overall"),
        F.when(F.col("copy") == 1, "7")
        .when(F.col("l_quantity") > 45, F.concat(F.lit("1,0"), quantity))
        .when(F.col("l_quantity") > 25, quantity)
        .alias("vote"),
        F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False).alias("verified"),
        F.concat(
            F.date_format(shipped, "M d, yyyy"), F.when(number == 6, " at noon").otherwise("")
        ).alias("reviewTime"),
        F.concat(F.lit(" U"), F.col("o_custkey").cast("string")).alias("reviewerID"),
        _asin(F.col("l_partkey")).alias("asin"),
        F.when(number == 7, F.lit(None))
        .when((number == 6) & (F.col("l_linestatus") == "F"), "  ")
        .otherwise(
            F.repeat(
                F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(" &amp;  fine.\n")),
                F.floor(F.col("l_quantity") / 10).cast("int") + 1,
            )
        )
        .alias("reviewText"),
        F.when(
            F.col("l_linestatus") == "O",
            F.concat(F.lit("Order "), F.col("l_orderkey").cast("string"), F.lit(" &quot;ok&quot;")),
        ).alias("summary"),
        F.unix_seconds(shipped).alias("unixReviewTime"),
        F.when(
            number != 5,
            F.struct(
                F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
                F.col("l_linestatus").alias("status"),
            ),
        ).alias("style"),
    )


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per event, keyed by user; error events arrive without their last brace."""
    events = table(spark, sf_dir, "events")
    whole = F.concat(
        F.lit('{"asin":"'),
        F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("A"), F.col("user_id"))),
        F.lit('","title":"'),
        F.col("event_type"),
        F.lit('","price":"'),
        F.col("event_id"),
        F.lit('","category":["'),
        F.col("event_type"),
        F.lit('","all"],"rank":"'),
        F.col("user_id"),
        F.lit('","props":'),
        F.col("props"),
        F.lit("}"),
    )
    cut = F.left(whole, F.length(whole) - 1)
    return events.select(F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("line"))


def stored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector table from ``embeddings``, written by an earlier run."""
    vectors = table(spark, sf_dir, "embeddings")
    earlier = F.timestamp_seconds(F.lit(1704067200))
    return vectors.select(
        _review_id(F.col("vec_id")).alias("review_id"),
        F.concat(F.lit("A"), F.col("label")).alias("asin"),
        F.concat(F.lit("U"), F.col("vec_id")).alias("reviewer_id"),
        F.timestamp_seconds(F.lit(1600000000) + F.col("vec_id") * 60).alias("review_timestamp"),
        F.sha2(F.concat(F.lit("text "), F.col("vec_id")), 256).alias("text_hash"),
        F.lit("model-1").alias("model_version"),
        "embedding",
        earlier.alias("created_at"),
        earlier.alias("updated_at"),
    )


def vector_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch over the same table: label 0 holds new reviews, 1 and 2 new texts, 3 a new model."""
    vectors = table(spark, sf_dir, "embeddings")
    label, key = F.col("label"), F.col("vec_id")
    text = F.when(label.isin(1, 2), F.concat(F.lit("new text "), key)).otherwise(F.concat(F.lit("text "), key))
    return vectors.select(
        F.when(label == 0, F.concat(F.lit("N"), key)).otherwise(_review_id(key)).alias("review_id"),
        F.concat(F.lit("B"), label).alias("asin"),
        F.concat(F.lit("U"), key).alias("reviewer_id"),
        F.timestamp_seconds(F.lit(1700000000) + key * 60).alias("review_timestamp"),
        F.lit("2024-02-01").cast("date").alias("ingest_dt"),
        F.sha2(text, 256).alias("text_hash"),
        F.when(label == 3, "model-2").otherwise("model-1").alias("model_version"),
        F.transform("embedding", lambda x: (-x).cast("float")).alias("embedding"),
    )


def _review_id(key: Column) -> Column:
    return F.concat(F.lit("R"), key)
