"""Removal of lines that many documents share, with levelled sorted runs of line hashes.

A line's key is the line stripped of white space at both ends with A-Z in lower case; 128 bits of hash stand for it.
``LineRuns`` keeps, like a log-structured merge tree, sorted tables of (hash, documents, largest document): every batch
adds one run at level zero, and ``fanout`` runs of a level are merged into one of the next, so a corpus of n batches has
about log n levels and each hash is rewritten once per level. Each new batch is merge-anti-joined with the runs; what none of them
holds goes into the batch's own run, and of what they hold only what changes: counts that still matter, and larger documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import hash128, lower_ascii, materialize, prepare, shards_for, table
from gristmill.session import fresh_dir

LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5
#: Batches at least, and documents of a batch beyond that.
BATCHES, BATCH_DOCUMENTS = 5, 50_000_000
FANOUT = 4
_STRIPPED = " \t\n\x0b\x0c\r"
_HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def row_key(id_column: str, text_column: str) -> Column:
    return F.xxhash64(F.col(id_column), F.col(text_column))


def line_keys(docs: DataFrame, id_column: str, text_column: str, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(row, doc, pos, h1, h2) of every line with a key of at least ``least_length`` code points; (doc, row) is the document."""
    lines = docs.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        row_key(id_column, text_column).alias("row"),
        F.col(id_column).cast("bigint").alias("doc"),
        F.posexplode(lines_of(F.col(text_column))).alias("pos", "line"),
    )
    keyed = lines.select("row", "doc", "pos", F.btrim(lower_ascii(F.col("line")), F.lit(_STRIPPED)).alias("key"))
    h1, h2 = hash128(F.col("key"), "line")
    return keyed.where(F.length("key") >= least_length).select("row", "doc", "pos", h1.alias("h1"), h2.alias("h2"))


class LineRuns:
    """Sorted runs of line hashes in levels. A key that is in ``enough`` documents is settled: only a larger document counts."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, enough: int = LEAST_DOCUMENTS):
        if fanout < 2:
            raise ValueError("a level needs at least two runs to be merged")
        self._spark, self._fanout, self._enough = spark, fanout, enough
        self.levels: list[list[DataFrame]] = []

    def add(self, keys: DataFrame) -> None:
        """Add a batch of line keys: those that no run holds, as a run of its own, with what it adds to known ones.

        Known keys that are settled add nothing unless the batch has a larger document. Full levels are compacted.
        """
        run = keys.groupBy(*_HASH).agg(F.countDistinct("doc", "row").alias("documents"), F.max("doc").alias("largest"))
        if any(self.levels):
            run = materialize(run, "line-batch")
            before = self.merged().select(*_HASH, F.col("documents").alias("had"), F.col("largest").alias("reached"))
            settled = F.col("had") >= self._enough
            known = run.join(before, _HASH).where(~settled | (F.col("largest") > F.col("reached")))
            adds = known.select(*_HASH, F.when(settled, F.lit(0)).otherwise(F.col("documents")).alias("documents"), "largest")
            run = self.unseen(run).unionByName(adds)
        self._put(0, run)

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(materialize(run.sortWithinPartitions(*_HASH), f"line-run-{level}"))
        if len(self.levels[level]) == self._fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, _merged(full))

    def merged(self) -> DataFrame:
        """One row per hash over all runs: documents (of a settled key at least as many as settle it), largest document."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return self._spark.createDataFrame([], "h1 bigint, h2 bigint, documents bigint, largest bigint")
        return runs[0] if len(runs) == 1 else _merged(runs)

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys no run holds, by an anti-join with each run in turn."""
        return reduce(lambda left, run: left.join(run, _HASH, "left_anti"), [r for level in self.levels for r in level], keys)


def _merged(runs: list[DataFrame]) -> DataFrame:
    together = reduce(DataFrame.unionByName, runs)
    return together.groupBy(*_HASH).agg(F.sum("documents").alias("documents"), F.max("largest").alias("largest"))


def deduplicate(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
    batches: int | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with the kept lines as text and the columns n_lines and n_dropped (existing ones of that name give way).

    A key found in at least ``least_documents`` documents loses all its lines except in the largest id that holds it.
    Rows equal in id and text are one document; they get the same result. Null and empty texts are one empty line and
    give an empty text. Rows without an id keep all lines and are not counted. Texts of any length are read whole. The number of
    batches follows the number of documents unless it is given. An empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    batches = batches or shards_for(docs.count(), BATCH_DOCUMENTS, BATCHES)
    keys = line_keys(docs, id_column, text_column, least_length).withColumn("batch", F.pmod("row", F.lit(batches)).cast("int"))
    path = fresh_dir(spark, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    runs = LineRuns(spark, fanout, least_documents)
    for number in range(batches):
        runs.add(keys.where(F.col("batch") == number).drop("batch"))
    frequent = materialize(runs.merged().where(F.col("documents") >= least_documents), "frequent-lines")
    lost = keys.join(frequent, _HASH).where(F.col("doc") < F.col("largest"))
    dropped = lost.groupBy(F.col("row").alias("_row"), F.col("doc").alias("_doc")).agg(F.collect_list("pos").alias("_dropped"))
    keyed = docs.withColumns({"_row": row_key(id_column, text_column), "_doc": F.col(id_column).cast("bigint")})
    met = keyed.join(dropped, ["_row", "_doc"], "left").drop("_row", "_doc")
    # Several uses keep the optimizer from moving the split into the function below, where it would run per line.
    split = met.withColumn("_lines", lines_of(F.col(text_column))).withColumn("_dropped", F.array_distinct("_dropped"))
    n_lines = F.size("_lines").cast("bigint")
    n_dropped = F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint")
    # array_except works on a hash set, so a text costs time in proportion to its lines.
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    joined = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("_dropped").isNull(), F.coalesce(F.col(text_column), F.lit(""))).otherwise(joined)
    others = [c for c in docs.columns if c not in (text_column, "n_lines", "n_dropped")]
    return split.select(*others, text.alias(text_column), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    done = deduplicate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id < largest) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE largest IS NULL OR doc_id >= largest), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (key)
GROUP BY doc_id
"""
