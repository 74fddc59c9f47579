"""The raw layer: batches of gzipped JSON lines, each described by a manifest.

A manifest has two parts, the same for any number of files: a header of one row per batch and a list of one row per
file. Both are only ever appended to, the header last, so a batch counts once its header is there.
"""

from __future__ import annotations

import decimal
import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.session import path_exists

log = logging.getLogger(__name__)

# The manifest format.
MANIFEST_VERSION = "1.0"
RAW_FORMAT = "jsonl.gz"
RECORDS_PER_FILE = 5000

#: Records per file of the scheduled job; the format's own default would cut large extracts into millions of files.
JOB_RECORDS_PER_FILE = 1_000_000

HEADER_SCHEMA = (
    "manifest_version string, "
    "source struct<name: string>, "
    "run struct<ingest_dt: string, extract_ts_utc: string, mode: string, batch_no: bigint>, "
    "s3 struct<bucket: string, prefix: string, format: string, batch: string>, "
    "counts struct<records: bigint, files: bigint, hash_sum: decimal(38,0), hash_xor: bigint>, "
    "incremental struct<enabled: boolean, cursor_field: string, watermark_in: string, watermark_out: string>, "
    "extraction struct<state: bigint, cursor_type: string, overlap: string>"
)
FILES_SCHEMA = "batch string, file string, records bigint, hash_sum decimal(38,0), hash_xor bigint"

_CHECKSUM_TYPES = {"records": "bigint", "hash_sum": "decimal(38,0)", "hash_xor": "bigint"}
_TEXT_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BinaryType)


class StoredLinesDiffer(RuntimeError):
    """A batch's stored lines are not the records that came from the source."""


@dataclass(frozen=True)
class Cursor:
    """Incremental bookkeeping of one run. ``state`` is the entry of the cursor's log that the run started from."""

    field: str | None = None
    enabled: bool = False
    watermark_in: str | None = None
    watermark_out: str | None = None
    state: int = 0
    kind: str | None = None
    overlap: str | None = None


def raw_prefix(entity: str, ingest_dt: str) -> str:
    return f"raw/{entity}/ingest_dt={ingest_dt}/"


def manifest_path(root: str, entity: str, ingest_dt: str) -> str:
    return f"{root}/manifests/{entity}/ingest_dt={ingest_dt}"


@dataclass(frozen=True)
class Batch:
    """A written batch: where it lies below the root, and what was observed of its records before they reached the writer."""

    root: str
    prefix: str
    name: str
    records: int
    hash_sum: decimal.Decimal
    hash_xor: int
    last_cursor: str | None = None

    @property
    def path(self) -> str:
        return f"{self.root}/{self.prefix}{self.name}"


@dataclass(frozen=True)
class Manifest:
    """``header`` has one row per batch with the checksum of the records before they were written, ``files`` one per stored
    file, named below the root, with the checksum of the lines it holds."""

    header: DataFrame
    files: DataFrame


def as_lines(df: DataFrame) -> Column:
    """Each record as the JSON text that is stored: values JSON has no form for as text, nulls kept."""
    readable = [
        F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, _TEXT_TYPES) else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return F.to_json(F.struct(*readable), {"ignoreNullFields": "false"})


def checksum(line: Column) -> list[Column]:
    """``records, hash_sum, hash_xor`` of a multiset of lines, in any order and over any number of tasks.

    The sum tells a doubled line from none, which the exclusive or alone does not; a lost and an added line that leave
    both as they were would have to collide in 64 bits twice over.
    """
    digest = F.xxhash64(line)
    return [
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor(digest), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def write_batch(
    df: DataFrame,
    root: str,
    entity: str,
    ingest_dt: str,
    records_per_file: int = RECORDS_PER_FILE,
    cursor_field: str | None = None,
) -> Batch:
    """Write a frame as a new batch of gzipped JSON lines.

    Batches are never overwritten; each lies in a folder of its own below the date prefix. The records' checksum and the
    highest cursor value are taken by the writing tasks before the writer sees the lines, so the source is read once.
    """
    prefix, name = raw_prefix(entity, ingest_dt), f"batch-{uuid.uuid4().hex}"
    seen = Observation()
    columns = [as_lines(df).alias("value")] + ([F.col(f"`{cursor_field}`").alias("cursor")] if cursor_field else [])
    lines = df.select(*columns)
    cursor = F.max("cursor").cast("string") if cursor_field else F.max(F.lit(None).cast("string"))
    observed = lines.observe(seen, *checksum(F.col("value")), cursor.alias("last_cursor")).select("value")
    writer = observed.write.option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    writer.text(f"{root}/{prefix}{name}")
    found = seen.get
    return Batch(root, prefix, name, found["records"], found["hash_sum"], found["hash_xor"], found["last_cursor"])


def _in_folder(path: Column) -> Column:
    """The last folder and the name of a file: what a listed and a stored file have in common whatever the root."""
    return F.substring_index(path, "/", -2)


def _stored_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``path`` of everything in the folders, in one listing; nothing is read."""
    return spark.read.format("binaryFile").load(folders).select("path")


def batch_files(spark: SparkSession, batch: Batch) -> DataFrame:
    """``file`` of every stored file of a batch."""
    name = F.substring_index("path", "/", -1)
    return _stored_files(spark, [batch.path]).select(F.concat(F.lit(f"{batch.prefix}{batch.name}/"), name).alias("file"))


def stored_checksums(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``in_folder, records, hash_sum, hash_xor`` of every file with lines, computed from the lines: an audit that reads them all."""
    lines = spark.read.text(folders).select(_in_folder(F.col("_metadata.file_path")).alias("in_folder"), "value")
    return lines.groupBy("in_folder").agg(*checksum(F.col("value")))


def records_per_file(spark: SparkSession, batch: Batch) -> DataFrame:
    """``file, records`` counted from the stored lines."""
    found = stored_checksums(spark, [batch.path])
    return found.select(F.concat(F.lit(batch.prefix), "in_folder").alias("file"), "records")


def build_manifest(
    spark: SparkSession,
    batch: Batch,
    entity: str,
    ingest_dt: str,
    extract_ts_utc: str,
    mode: str = "one_shot",
    cursor: Cursor = Cursor(),
    batch_no: int = 1,
) -> Manifest:
    """The manifest of a written batch. ``batch_no`` counts the batches of one date in the order they were written.

    Files are described by what is read back from them; an empty one has no lines to read.
    """
    sums = stored_checksums(spark, [batch.path])
    files = batch_files(spark, batch).withColumn("in_folder", _in_folder(F.col("file"))).join(sums, "in_folder", "left")
    files = files.select(
        F.lit(batch.name).alias("batch"),
        "file",
        *[F.coalesce(name, F.lit(0)).cast(kind).alias(name) for name, kind in _CHECKSUM_TYPES.items()],
    )
    header = spark.range(1).select(
        F.lit(MANIFEST_VERSION).alias("manifest_version"),
        F.struct(F.lit(entity).alias("name")).alias("source"),
        F.struct(
            F.lit(ingest_dt).alias("ingest_dt"),
            F.lit(extract_ts_utc).alias("extract_ts_utc"),
            F.lit(mode).alias("mode"),
            F.lit(batch_no).cast("bigint").alias("batch_no"),
        ).alias("run"),
        F.struct(
            F.lit(batch.root).alias("bucket"),
            F.lit(batch.prefix).alias("prefix"),
            F.lit(RAW_FORMAT).alias("format"),
            F.lit(batch.name).alias("batch"),
        ).alias("s3"),
        F.struct(
            F.lit(batch.records).cast("bigint").alias("records"),
            F.lit(batch_files(spark, batch).count()).alias("files"),
            F.lit(str(batch.hash_sum)).cast("decimal(38,0)").alias("hash_sum"),
            F.lit(batch.hash_xor).cast("bigint").alias("hash_xor"),
        ).alias("counts"),
        F.struct(
            F.lit(cursor.enabled).alias("enabled"),
            F.lit(cursor.field).cast("string").alias("cursor_field"),
            F.lit(cursor.watermark_in).cast("string").alias("watermark_in"),
            F.lit(cursor.watermark_out).cast("string").alias("watermark_out"),
        ).alias("incremental"),
        F.struct(
            F.lit(cursor.state).cast("bigint").alias("state"),
            F.lit(cursor.kind).cast("string").alias("cursor_type"),
            F.lit(cursor.overlap).cast("string").alias("overlap"),
        ).alias("extraction"),
    )
    return Manifest(header, files)


def write_manifest(manifest: Manifest, path: str) -> None:
    """Add a batch to the manifests of its date: the file list, then the header that makes it count."""
    manifest.files.write.mode("append").json(f"{path}/files")
    manifest.header.write.mode("append").option("ignoreNullFields", "false").json(f"{path}/headers")


def next_batch_no(spark: SparkSession, path: str) -> int:
    if not path_exists(spark, f"{path}/headers"):
        return 1
    header = spark.read.schema(HEADER_SCHEMA).json(f"{path}/headers")
    return (header.agg(F.max("run.batch_no").alias("n")).first()["n"] or 0) + 1


def read_manifest(spark: SparkSession, path: str, batch: str | None = None) -> Manifest:
    """One batch of a date, or all that count: the newest complete extract and the increments after it."""
    header = spark.read.schema(HEADER_SCHEMA).json(f"{path}/headers")
    if batch is not None:
        header = header.where(F.col("s3.batch") == batch)
    else:
        newest = header.where(F.col("run.mode") != "incremental").agg(F.max("run.batch_no").alias("n")).first()["n"]
        header = header.where(F.col("run.batch_no") >= (newest or 0))
    files = spark.read.schema(FILES_SCHEMA).json(f"{path}/files")
    return Manifest(header, files.join(header.select("s3.batch"), "batch", "left_semi"))


def read_document(spark: SparkSession, path: str) -> Manifest:
    """A manifest kept as a single, possibly indented document that names its files in ``s3.files``; it has no checksums."""
    schema = HEADER_SCHEMA.replace("batch: string", "files: array<string>")
    document = spark.read.schema(schema).option("multiLine", "true").json(path)
    nothing = F.lit(None).cast("string").alias("batch")
    header = document.withColumn("s3", F.struct("s3.bucket", "s3.prefix", "s3.format", nothing))
    blank = [F.lit(None).cast(kind).alias(name) for name, kind in _CHECKSUM_TYPES.items()]
    return Manifest(header, document.select(nothing, F.explode("s3.files").alias("file"), *blank))


def _folders(manifest: Manifest) -> list[str]:
    """The batches' folders. The list is as long as the batches of a date are many; files are never listed here."""
    batches = manifest.header.select("s3.*").collect()
    return [f"{b['bucket'].rstrip('/')}/{b['prefix']}{b['batch'] or ''}".rstrip("/") for b in batches]


def read_raw(spark: SparkSession, manifest: Manifest, schema: T.StructType | None = None) -> DataFrame:
    """The records of a manifest's batches. Without a schema Spark infers one, at the price of an extra scan.

    Whole folders are read, however many there are, in one listing and one scan, and no list of file names passes through
    the driver. A file that is listed but not stored, or stored but not listed, is an error.
    """
    folders = _folders(manifest)
    if not folders or manifest.files.isEmpty():
        raise ValueError("the manifest lists no files")
    odd = compare_files(spark, manifest).take(5)
    if odd:
        raise ValueError(f"manifest and folder differ: {', '.join(row['file'] for row in odd)}")
    reader = spark.read.option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).json(folders)


def compare_files(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """``file, is_listed, is_stored`` of the files that the manifest and the folders do not both have."""
    listed = manifest.files.select("file", _in_folder(F.col("file")).alias("in_folder"))
    stored = _stored_files(spark, _folders(manifest)).select("path", _in_folder(F.col("path")).alias("in_folder"))
    both = listed.join(stored, "in_folder", "full_outer")
    odd = both.where(F.col("file").isNull() | F.col("path").isNull())
    below = F.col("path")
    for row in manifest.header.select("s3.bucket").distinct().collect():
        below = F.substring_index(below, f"{row['bucket'].rstrip('/')}/", -1)
    return odd.select(
        F.coalesce("file", below).alias("file"), F.col("file").isNotNull().alias("is_listed"), F.col("path").isNotNull().alias("is_stored")
    )


def reconcile(manifest: Manifest, source_records: int | None = None) -> Row:
    """What came from the source against what is stored, batch by batch; a difference is logged, not raised.

    The one side was taken before the writer, the other read back from the files. ``source_records`` is a count the source
    itself gave, compared besides.
    """
    counts = manifest.header.select(F.col("s3.batch").alias("batch"), *[F.col(f"counts.{c}").alias(c) for c in _CHECKSUM_TYPES])
    stored = manifest.files.groupBy("batch").agg(
        F.sum("records").alias("stored_records"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("stored_sum"),
        F.bit_xor("hash_xor").alias("stored_xor"),
    )
    both = counts.join(stored, counts["batch"].eqNullSafe(stored["batch"]), "full_outer")
    same = F.struct("records", "hash_sum", "hash_xor") == F.struct("stored_records", "stored_sum", "stored_xor")
    row = both.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("source_records"),
        F.coalesce(F.sum("stored_records"), F.lit(0)).alias("written_records"),
        F.coalesce(F.every(F.coalesce(same, F.lit(False))), F.lit(True)).alias("lines_match"),
    ).first()
    taken = row["source_records"] if source_records is None else source_records
    matches = row["lines_match"] and taken == row["written_records"]
    result = Row(source_records=taken, written_records=row["written_records"], lines_match=row["lines_match"], matches=matches)
    if not matches:
        log.warning("source and stored lines differ: %s", result)
    return result


def audit(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """``file, listed_records, stored_records`` of every file whose lines are not those the manifest was written for.

    Reads all lines again; finds what happened to files after their batch was written, a lost file included.
    """
    folders = _folders(manifest)
    now = stored_checksums(spark, folders).select("in_folder", *[F.col(c).alias(f"now_{c}") for c in _CHECKSUM_TYPES])
    listed = manifest.files.withColumn("in_folder", _in_folder(F.col("file")))
    both = listed.join(now, "in_folder", "full_outer")
    zero = F.lit(0)
    same = [F.coalesce(c, zero) == F.coalesce(f"now_{c}", zero) for c in _CHECKSUM_TYPES]
    odd = both.where(F.col("file").isNull() | ~(same[0] & same[1] & same[2]))
    return odd.select(
        F.coalesce("file", "in_folder").alias("file"),
        F.coalesce("records", zero).cast("bigint").alias("listed_records"),
        F.coalesce("now_records", zero).cast("bigint").alias("stored_records"),
    )
