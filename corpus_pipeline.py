"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import decontaminate, language, line_dedup, packing, simhash
from gristmill.llm.common import materialize, prepare, small, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Words that a worker of the packing stage remembers; the stages before it have left their share of memory in use.
REMEMBERED = 150_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, whatever the model says; the prediction only fills null languages.

    If there is nothing to learn from (no language given), null languages become ``und`` and all documents with a letter stay.
    """
    prepare(spark)
    known = language.identify(docs)
    kept = known.where(language.lettered(F.col("text")) | (F.col("lang_pred") != language.UNDETERMINED))
    return _documents(kept.withColumn("lang", F.coalesce("lang", "lang_pred")))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one; documents left without any word go."""
    prepare(spark)
    done = line_dedup.deduplicate(docs)
    return _documents(done.where(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near-duplicates stays, once; rows of one id and different texts are different documents."""
    prepare(spark)
    key = F.struct(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("text"))
    keyed = docs.where(F.col("doc_id").isNotNull()).withColumn("_key", key)
    groups = simhash.near_duplicates(keyed, "_key")
    first = groups.where(F.col("_key") == F.col("component_id")).select("_key").distinct()
    kept = keyed.join(first, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")
    return _documents(kept.unionByName(docs.where(F.col("doc_id").isNull())))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    keyed = docs.withColumn("_text", F.xxhash64("doc_id", "text"))
    same = (F.col("_text") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return _documents(keyed.join(small(found.distinct()), same, "left_anti"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its place in a sequence."""
    prepare(spark)
    return packing.pack(docs, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Language, near-duplicates and tokens cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
