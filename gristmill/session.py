"""Session settings and the shared working folder every job in this package relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that can be changed on a running session. Arrow batches are bounded by bytes as well as rows,
#: because one row may be a whole document. The group limit keeps one row per key before the shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}
#: Settings of the jobs on tables and texts. What they write is read a few times at most, so fewer bytes count more than the seconds.
#: Shuffled rows of numbers grow thirtyfold in the sort behind their join, when texts and keys are made of them: partitions that the
#: planner merges up to its usual 64 MB would be sorted on disk. What a step shuffled goes when the step has ended, not when the driver
#: happens to collect its garbage: jobs of many steps would keep the shuffles of all on disk. A frame that is run again shuffles again.
TABLE_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
}

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Temporary folders of local sessions that name none.
_LOCAL_DIRS: dict[str, str] = {}


def tune(spark: SparkSession, more: Mapping[str, str] = {}) -> SparkSession:
    """Apply the runtime settings, and ``more``, to a session somebody else built."""
    for key, value in {**RUNTIME_SETTINGS, **more}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "gristmill", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster; a temporary one only for a local master."""
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="gristmill-")
    return _LOCAL_DIRS[application]


def application_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; Hadoop removes it when the application ends."""
    path = f"{shared_dir(spark)}/gristmill/{spark.sparkContext.applicationId}"
    files, folder = hadoop(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop(spark, path)
    return files.exists(target)


def hadoop(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path and the path in its form."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the application's folder that nothing else uses; it does not exist yet."""
    return f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back.

    The written table cuts the lineage, survives the loss of executors, and lets each branch read only
    the columns it needs.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A :func:`materialize` whose tables are removed at the end of the block; nothing may read them later."""
    paths = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(fresh_dir(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            files, folder = hadoop(spark, path)
            files.delete(folder, True)
