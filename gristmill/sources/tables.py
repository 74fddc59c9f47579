"""Partitioned Parquet datasets and catalog tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import hadoop
from gristmill.sources.commitlog import CommitLog

PARTITION = "ingest_dt"

#: Table providers whose catalogs replace a table in one commit.
REPLACING_PROVIDERS = ("iceberg", "delta")


def write_partitions(
    df: DataFrame,
    path: str,
    partition: str = PARTITION,
    sort_by: str | None = None,
    spread: bool = False,
) -> None:
    """Replace only the partitions present in the frame.

    ``sort_by`` orders rows inside each file, which makes row-group statistics selective for that column.
    ``spread`` is for frames whose tasks each hold many partition values: it lets the adaptive planner
    regroup rows by partition, splitting the large ones, instead of writing many small files.
    """
    if spread:
        df = df.hint("rebalance", partition)
    if sort_by:
        df = df.sortWithinPartitions(partition, sort_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def read_partition(spark: SparkSession, path: str, value: str | dt.date, partition: str = PARTITION) -> DataFrame:
    """One partition of a dataset, pruned at planning time and with the partition column kept."""
    return read_all(spark, path).where(F.col(partition) == F.lit(str(value)).cast("date"))


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Every partition of a dataset."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def publish_table(
    df: DataFrame,
    name: str,
    provider: str = "parquet",
    root: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace the content of a catalog table, whatever its columns were.

    Providers that support it commit the replacement themselves. For plain Parquet each version is written to a new
    folder below ``root``, and the catalog entry is a view of the current folder, which is replaced in one step:
    readers see the old or the new version, and a job may read what it replaces. ``check`` gets what was written
    before the view points at it, and may raise; a provider that replaces the table itself is checked afterwards.
    """
    spark = df.sparkSession
    if provider in REPLACING_PROVIDERS:
        df.writeTo(name).using(provider).createOrReplace()
        if check:
            check(spark.table(name))
        return
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    location = f"{root.rstrip('/')}/{name.replace('.', '/')}/version-{uuid.uuid4().hex}"
    df.write.format(provider).save(location)
    if check:
        check(spark.read.format(provider).load(location))
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT * FROM {provider}.`{location}`")


# Versions in plain folders: each is written to a folder of its own, then a numbered log entry names it.


@dataclass(frozen=True)
class Version:
    """Where the parts of a version lie. A table in one piece has part 0 only; number 0 is no version at all."""

    number: int
    parts: dict[int, str]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(*self.parts.values())


def new_version_path(base: str) -> str:
    return f"{base}/version-{uuid.uuid4().hex}"


def version_log(spark: SparkSession, base: str) -> CommitLog:
    return CommitLog(spark, f"{base}/versions")


def _version(number: int, entry: dict) -> Version:
    return Version(number, {int(part): location for part, location in entry.get("parts", {}).items()})


def current_version(spark: SparkSession, base: str) -> Version:
    """The newest version. An entry names every part; their number is fixed when the table is laid out."""
    return _version(*version_log(spark, base).last())


def commit_version(
    spark: SparkSession,
    base: str,
    before: Version,
    parts: dict[int, str],
    again: Callable[[Version, list[int]], dict[int, str]] | None = None,
    check: Callable[[Version], None] | None = None,
) -> Version:
    """Make written parts, which replace those of ``before``, part of the current version; returns that.

    Only one writer gets a number. One that finds a newer version than it started from keeps what the others wrote in
    parts it did not touch; the parts that both touched are handed to ``again``, which merges into the newer version and
    returns the new locations. Without ``again`` the last writer's parts count. ``check`` gets each candidate
    before it is tried, and may raise.
    """
    log = version_log(spark, base)
    while True:
        current = _version(*log.last())
        theirs = {p for p in current.parts if current.parts[p] != before.parts.get(p)}
        both = sorted(theirs & parts.keys())
        if both and again:
            parts = parts | again(current, both)
        before = current
        candidate = Version(current.number + 1, current.parts | parts)
        if check:
            check(candidate)
        written = dt.datetime.now(dt.timezone.utc).timestamp()
        if log.add(candidate.number, {"parts": candidate.parts, "written": written}):
            return candidate


def sweep_versions(spark: SparkSession, base: str, keep: int = 5, grace_seconds: float = 7 * 86400) -> int:
    """Remove what no version that is still kept names; returns the number of folders removed.

    The newest ``keep`` versions stay, and those replaced less than ``grace_seconds`` ago, for readers that have
    opened them. Folders with a file younger than that stay too: a writer may be about to name them. Log entries go first and
    folders after them, so an entry never names what is gone; a sweep that dies in between leaves folders that the next one
    finds. The listing and the comparison with the named folders are a job; what is left is removed folder by folder.
    """
    if keep < 1:
        raise ValueError("the current version cannot be removed")
    log = version_log(spark, base)
    entries = [(number, log.read(number)) for number in log.numbers()]
    limit = dt.datetime.now(dt.timezone.utc).timestamp() - grace_seconds
    # A version is replaced when the next one is written.
    replaced = {number: later["written"] for (number, _), (_, later) in zip(entries, entries[1:])}
    first = next((at for at in range(len(entries)) if at >= len(entries) - keep or replaced[entries[at][0]] >= limit), 0)
    kept = entries[first:]
    if kept:
        log.drop_before(kept[0][0])
    named = {location.rstrip("/") for _, entry in kept for location in entry["parts"].values()}
    key = F.regexp_extract("folder", r"(version-[0-9a-f]{32}(?:/[^/]+)?)$", 1)
    marked = spark.createDataFrame([(x,) for x in sorted(named)], "folder string").select(key.alias("key")).distinct()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        stored = listed.load(f"{base}/version-*").select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"), "modificationTime")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    ages = stored.groupBy("folder").agg(F.max("modificationTime").alias("youngest"))
    old = ages.where(F.col("youngest") < F.timestamp_micros(F.lit(int(limit * 1e6)))).withColumn("key", key)
    dead, removed = old.join(marked, "key", "left_anti").select("folder"), 0
    for row in dead.toLocalIterator():
        files, folder = hadoop(spark, row["folder"])
        files.delete(folder, True)
        parent = folder.getParent()
        left = [s.getPath().getName() for s in files.listStatus(parent)] if parent.getName().startswith("version-") else [""]
        if all(name.startswith(("_", ".")) for name in left):
            files.delete(parent, True)
        removed += 1
    return removed
