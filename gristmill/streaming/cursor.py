"""Incremental extraction by a cursor, without losing rows that share the watermark.

Rows may arrive late: with the cursor value the last run ended at, since cursors can be as coarse as days, with a somewhat
smaller one, or with none at all. So a run takes the rows from the watermark on, the watermark included, less what is in
the boundary set: the digests of the rows taken before whose cursor lies in the open stretch (from the watermark, less an
optional ``overlap``, upward) or is null. Each run adds the digests of what it took to the set.

The state of an entity is a log of numbered entries; the newest one has the watermark and names the folders of the boundary
set. A run that dies before it commits leaves the state as it was, so the next run reads the same rows again. Of two runs
that took rows from one state only the first commits.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.sources.commitlog import CommitLog, Conflict
from gristmill.sources.raw import Batch, as_lines

#: Folders of the boundary set that are read together; one more and they become one.
MOST_FOLDERS = 16
TAKEN_SCHEMA = "cursor string, digest string"


@dataclass(frozen=True)
class State:
    """Where an entity's extraction stands. Number 0 is before the first run."""

    number: int = 0
    watermark: str | None = None
    folders: list[str] = field(default_factory=list)


def state_path(root: str, entity: str) -> str:
    return f"{root}/raw-state/{entity}"


def read_state(spark: SparkSession, root: str, entity: str) -> State:
    number, entry = CommitLog(spark, f"{state_path(root, entity)}/log").last()
    return State(number, entry.get("watermark"), entry.get("folders", []))


def last_watermark(spark: SparkSession, root: str, entity: str) -> str | None:
    """The newest committed watermark, or null before the first run."""
    return read_state(spark, root, entity).watermark


def digest(line: Column) -> Column:
    """128 bits of a record's stored text: equal for equal records, whenever they are extracted."""
    return F.md5(line)


def _bound(watermark: Column | str, kind: T.DataType, overlap: str | int | None) -> Column:
    """Where the open stretch begins. ``overlap`` is a number for numeric cursors, an interval such as '2 days' for times."""
    at = F.lit(watermark).cast(kind) if isinstance(watermark, str) else watermark
    if overlap is None:
        return at
    if isinstance(kind, T.NumericType):
        return (at - F.lit(overlap)).cast(kind)
    return (at - F.expr(f"INTERVAL {overlap}")).cast(kind)


def boundary(lines: DataFrame, field_name: str, watermark: str | None, kind: T.DataType, overlap: str | int | None = None) -> DataFrame:
    """``cursor, digest`` of the stored lines (``value``) whose cursor lies in the open stretch or is null.

    A line's cursor is parsed once for the test, and again only of the few lines that pass it.
    """
    cursor = F.get_json_object("value", f"$['{field_name}']")

    def open_(c: Column) -> Column:
        return c.isNull() if watermark is None else c.isNull() | (c.cast(kind) >= _bound(watermark, kind, overlap))

    met = lines.where(F.exists(F.array(cursor), open_))
    return met.select(cursor.alias("cursor"), digest(F.col("value")).alias("digest"))


def after(df: DataFrame, field_name: str, watermark: Column | str | None) -> DataFrame:
    """Rows past a watermark; all rows when there is none. The filter reaches the scan."""
    if watermark is None:
        return df
    return df.where(F.col(f"`{field_name}`") > _bound(watermark, df.schema[field_name].dataType, None))


def taken(spark: SparkSession, state: State, kind: T.DataType, overlap: str | int | None = None) -> DataFrame:
    """``cursor, digest`` of the boundary set: rows taken before that a run from this state meets again."""
    if not state.folders:
        return spark.createDataFrame([], TAKEN_SCHEMA)
    stored = spark.read.schema(TAKEN_SCHEMA).parquet(*state.folders)
    if state.watermark is None:
        return stored.where(F.col("cursor").isNull())
    return stored.where(F.col("cursor").isNull() | (F.col("cursor").cast(kind) >= _bound(state.watermark, kind, overlap)))


def pending(df: DataFrame, field_name: str, state: State, overlap: str | int | None = None) -> DataFrame:
    """The rows that no committed run has taken.

    Rows past the watermark go straight through. Only those in the open stretch and those without a cursor are compared with
    the boundary set; a row that is there with another content was changed and is taken again. Equal rows are one.
    """
    if not state.number:
        return df
    kind, at = df.schema[field_name].dataType, F.col(f"`{field_name}`")
    met = at.isNull()
    if state.watermark is not None:
        met = met | ((at >= _bound(state.watermark, kind, overlap)) & (at <= F.lit(state.watermark).cast(kind)))
        newer = df.where(at > F.lit(state.watermark).cast(kind))
    else:
        newer = df.where(at.isNotNull())
    name = f"_digest_{uuid.uuid4().hex}"
    seen = taken(df.sparkSession, state, kind, overlap).select(F.col("digest").alias(name))
    met_again = df.where(met)
    unseen = met_again.withColumn(name, digest(as_lines(met_again))).join(seen, name, "left_anti").drop(name)
    return newer.unionByName(unseen)


def reached(spark: SparkSession, state: State, last_cursor: str | None, kind: T.DataType) -> str | None:
    """The watermark after a batch; late rows alone do not move it back."""
    values = [F.lit(v).cast(kind) for v in (state.watermark, last_cursor) if v is not None]
    if len(values) < 2:
        return state.watermark if last_cursor is None else last_cursor
    return spark.range(1).select(F.greatest(*values).cast("string").alias("w")).first()["w"]


def watermark_out(batch: DataFrame, field_name: str) -> str | None:
    """Highest cursor value of a batch as text; null when the batch is empty."""
    return batch.agg(F.max(f"`{field_name}`").cast("string").alias("w")).first()["w"]


def commit(
    spark: SparkSession,
    root: str,
    entity: str,
    field_name: str,
    state: State,
    watermark: str | None,
    batch: Batch | None = None,
    kind: T.DataType | None = None,
    overlap: str | int | None = None,
) -> State:
    """Move the watermark from ``state`` and add the batch's rows to the boundary set, as they are stored.

    The set is written first and counts with the log entry. Another run that committed from the same state is a conflict: the
    rows of both overlap, so this one has to be extracted again.
    """
    base, kind = state_path(root, entity), kind or T.StringType()
    folders = state.folders
    if batch is not None:
        lines = spark.read.text(batch.path)
        rows = boundary(lines, field_name, watermark, kind, overlap)
        folder = f"{base}/taken/{uuid.uuid4().hex}"
        if len(folders) >= MOST_FOLDERS:
            before = taken(spark, State(state.number, watermark, folders), kind, overlap)
            rows, folders = rows.unionByName(before), []
        rows.distinct().write.parquet(folder)
        folders = [*folders, folder]
    entry = {
        "entity": entity,
        "cursor_field": field_name,
        "watermark": watermark,
        "folders": folders,
        "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
    }
    if not CommitLog(spark, f"{base}/log").add(state.number + 1, entry):
        raise Conflict(f"another run moved the watermark of {entity} from entry {state.number}; extract again")
    return State(state.number + 1, watermark, folders)
