"""Benchmark items inside documents: a size-partitioned MinHash containment search, verified exactly.

Items are partitioned by size (powers of two of their distinct shingles). An item's sketch holds its smallest shingle
hashes, as many as the largest size of its partition can miss at the wanted containment plus one; so a document that
contains enough of an item shares at least one hash with its sketch, however long the document is, and only document
hashes below the partitions' largest sketch value need to be looked up. Candidates are verified on the shingles themselves.

Signatures of whole documents would miss: the Jaccard similarity of a 20-word item and a 20,000-word text is 0.001.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import lower_ascii, materialize, prepare, small, table, words_of

SHINGLE = 5
CONTAINMENT = 0.8


def _grams(words: Column, size: int, build) -> Column:
    """Runs of ``size`` words, the whole sequence if it is shorter, none if it is empty; ``words`` must be a plain column."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: build([F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) >= size, runs)


def shingle_hashes(word_hashes: Column, size: int = SHINGLE) -> Column:
    """Hashes of the shingles of a text given by the hashes of its words."""
    whole = F.array(F.aggregate(word_hashes, F.lit(0).cast("bigint"), lambda acc, x: F.xxhash64(acc, x)))
    return F.when(F.size(word_hashes) == 0, F.array().cast("array<bigint>")).otherwise(
        F.coalesce(_grams(word_hashes, size, lambda parts: F.xxhash64(*parts)), whole)
    )


def shingles(words: Column, size: int = SHINGLE) -> Column:
    """Distinct shingles of a text as strings."""
    whole = F.array(F.array_join(words, " "))
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.coalesce(_grams(words, size, lambda parts: F.concat_ws(" ", *parts)), whole))
    )


def sketches(items: DataFrame, item_column: str, text_column: str, size: int, containment: float) -> DataFrame:
    """(item, n, grams, sketch): distinct shingles and the sketch of every item that has words."""
    worded = items.select(F.col(item_column).alias("item"), words_of(lower_ascii(F.col(text_column))).alias("words"))
    hashed = worded.withColumn("hw", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.select("item", shingles(F.col("words"), size).alias("grams"), shingle_hashes(F.col("hw"), size).alias("hashes"))
    sized = grams.where(F.size("grams") > 0).withColumn("n", F.size("grams"))
    # The largest size of the partition decides how many hashes a sketch takes; fewer items need that many than have them.
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n"))) + 1) - 1
    missing = largest - F.ceil(largest * containment - 1e-9)
    return sized.select("item", "n", "grams", F.slice(F.array_sort(F.array_distinct("hashes")), F.lit(1), (missing + 1).cast("int")).alias("sketch"))


def contaminated(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text_column: str = "text", size: int = SHINGLE, containment: float = CONTAINMENT,
) -> DataFrame:
    """(``id_column``, row, ``item_column``, n_shingles, n_found, containment) of each item a document contains.

    Containment is the share of the item's distinct shingles that the document has, A-Z in lower case, words separated
    by white space. ``row`` is a hash of id and text: rows with equal ids are separate documents, rows equal in both are
    one. Null and empty texts contain nothing and are contained in nothing; a text shorter than a shingle is one shingle.
    Documents without an id are searched too. Other columns are ignored; empty tables give an empty result.
    """
    prepare(docs.sparkSession)
    index = materialize(sketches(items, item_column, item_text_column, size, containment), "sketches")
    entries = materialize(index.select("item", F.explode("sketch").alias("hash")), "sketch-entries")
    highest = entries.agg(F.max("hash")).first()[0]
    keyed = docs.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.xxhash64(id_column, text_column).alias("row")
    )
    hashed = keyed.select("row", F.transform(words_of(lower_ascii(F.col("text"))), lambda w: F.xxhash64(w)).alias("hw"))
    low = F.filter(shingle_hashes(F.col("hw"), size), lambda h: h <= F.lit(highest if highest is not None else 0).cast("bigint"))
    looked_up = hashed.select("row", F.explode(low).alias("hash")).join(small(entries), "hash")
    pairs = materialize(looked_up.select("row", "item").distinct(), "candidates")
    texts = keyed.join(small(pairs.select("row").distinct()), "row", "left_semi").dropDuplicates(["row"])
    texts = texts.select("row", "id", words_of(lower_ascii(F.col("text"))).alias("words"))
    texts = texts.select("row", "id", shingles(F.col("words"), size).alias("has"))
    met = pairs.join(index.select("item", "n", "grams"), "item").join(texts, "row")
    found = met.select("id", "row", "item", "n", F.size(F.array_intersect("grams", "has")).alias("found"))
    enough = F.col("found") >= F.ceil(F.col("n") * containment - 1e-9)
    return found.where(enough).select(
        F.col("id").alias(id_column), "row", F.col("item").alias(item_column), F.col("n").alias("n_shingles"),
        F.col("found").alias("n_found"), (F.col("found") / F.col("n")).alias("containment"),
    )


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", F.round("containment", 6).alias("containment"))


OP10_SQL = r"""
WITH worded AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') FROM benchmark
), starts AS (
  SELECT kind, id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM worded WHERE len(words) > 0
), shingled AS (
  SELECT DISTINCT kind, id, array_to_string(words[i : i + 4], ' ') AS shingle FROM starts
), items AS (
  SELECT id AS item_id, shingle, count(*) OVER (PARTITION BY id) AS n FROM shingled WHERE kind = 'b'
), counted AS (
  SELECT d.id AS doc_id, item_id, any_value(n) AS n, count(*) AS found
  FROM items JOIN (SELECT * FROM shingled WHERE kind = 'd') d USING (shingle) GROUP BY d.id, item_id
)
SELECT doc_id, item_id, n::INTEGER AS n_shingles, found::INTEGER AS n_found, round(found / n, 6) AS containment
FROM counted WHERE found * 10 >= n * 8
"""
