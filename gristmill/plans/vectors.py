"""From staging reviews to the stored vector table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.parse import packed, unpacked
from gristmill.functions.text import embedding_text, text_digest
from gristmill.operators.contracts import require_columns
from gristmill.operators.dealing import deal_by_cost
from gristmill.operators.dedup import latest_by
from gristmill.operators.embedding import EncoderFactory, embed
from gristmill.operators.upsert import changed_rows, differs, not_stored_yet, upsert

DEFAULT_MODEL = "all-MiniLM-L6-v2"
DEFAULT_DIMENSION = 384

# The columns of the prepared and the embedded tables.
IDENTITY = ["review_id", "asin", "reviewer_id", "review_timestamp", "ingest_dt"]
PREPARED_COLUMNS = [*IDENTITY, "text_for_embedding", "text_hash", "model_version"]
EMBEDDED_COLUMNS = [*IDENTITY, "text_hash", "model_version", "embedding"]

#: Digests, which travel through shuffles in half their length.
DIGESTS = ("review_id", "text_hash")

#: A stored vector is replaced only when its text or its model changed.
CONTENT_CHANGED = differs("text_hash", "model_version")


def prepare(reviews: DataFrame, model_version: str = DEFAULT_MODEL) -> DataFrame:
    """Reviews with a text to embed, its hash and the model it is meant for."""
    require_columns(reviews, [*IDENTITY, "summary", "review_text"])
    text = embedding_text(F.col("summary"), F.col("review_text"))
    # A filter on the text would clean it a second time; unpacking a list that lost its null does not.
    texts = reviews.select(*IDENTITY, F.explode(F.array_compact(F.array(text))).alias("text_for_embedding"))
    return texts.select(
        "*", text_digest(F.col("text_for_embedding")).alias("text_hash"), F.lit(model_version).alias("model_version")
    )


def with_packed_digests(df: DataFrame) -> DataFrame:
    return df.withColumns({c: packed(F.col(c)) for c in DIGESTS})


def with_plain_digests(df: DataFrame) -> DataFrame:
    return df.withColumns({c: unpacked(F.col(c)) for c in DIGESTS})


def pending(prepared: DataFrame, stored: DataFrame) -> DataFrame:
    """Prepared rows whose text and model are not stored yet; only these need inference."""
    return not_stored_yet(prepared, stored, ["review_id", "text_hash", "model_version"])


def embed_reviews(prepared: DataFrame, encoder: EncoderFactory, batch_size: int = 32) -> DataFrame:
    """One unit-length vector per prepared row. Rows are dealt to tasks by the length of their texts."""
    require_columns(prepared, PREPARED_COLUMNS)
    prepared = with_plain_digests(deal_by_cost(with_packed_digests(prepared), F.length("text_for_embedding")))
    vector = embed(F.col("text_for_embedding"), encoder, batch_size)
    return prepared.withColumn("embedding", vector).select(*EMBEDDED_COLUMNS)


def embedded_schema(prepared: DataFrame) -> DataFrame:
    """No rows, with the columns that :func:`embed_reviews` gives."""
    nothing = F.lit(None).cast("array<float>")
    return prepared.where(F.lit(False)).withColumn("embedding", nothing).select(*EMBEDDED_COLUMNS)


def newest_per_review(batch: DataFrame) -> DataFrame:
    """A batch may span several ingestion dates; the newest row of a review counts."""
    return latest_by(batch, ["review_id"], *[c for c in ("ingest_dt",) if c in batch.columns])


def merge_vectors(stored: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """The vector table after the batch: unchanged rows stay exactly as stored."""
    return upsert(stored, newest_per_review(batch), ["review_id"], now, CONTENT_CHANGED)


def changed_vectors(stored: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """Only the rows a merge would write."""
    return changed_rows(stored, newest_per_review(batch), ["review_id"], now, CONTENT_CHANGED, reach=batch)


def apply_changes(stored: DataFrame, changed: DataFrame, now: Column) -> DataFrame:
    """The vector table after a written result of :func:`changed_vectors` is put in."""
    return upsert(stored, changed, ["review_id"], now, CONTENT_CHANGED, changed=changed)
