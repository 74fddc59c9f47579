"""Keyed merges expressed as joins, and the gate that leaves out what is stored already."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.contracts import require_columns


@dataclass(frozen=True)
class Gate:
    """Lets a known row through when any of its columns changed, null counting as a value."""

    columns: tuple[str, ...]

    def passes(self, stored: str, incoming: str) -> Column:
        changed = [~F.col(f"{stored}.{c}").eqNullSafe(F.col(f"{incoming}.{c}")) for c in self.columns]
        return reduce(Column.__or__, changed)

    def sql(self, stored: str, incoming: str) -> str:
        return " OR ".join(f"{stored}.{c} IS DISTINCT FROM {incoming}.{c}" for c in self.columns)


def differs(*columns: str) -> Gate:
    return Gate(columns)


def changed_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    now: Column,
    gate: Gate | None = None,
    reach: DataFrame | None = None,
) -> DataFrame:
    """The batch rows that must be stored: new keys, and known keys that pass the gate.

    Reads only the key, gate and ``created_at`` columns of the target. Rows come out in the target's
    schema, with ``created_at`` carried over and ``updated_at`` set. The batch is read twice, so hand in a
    written one, or one that holds its keys as ``reach``, for a batch that is made of it.
    """
    require_columns(batch, keys)
    gate_columns = gate.columns if gate else ()
    kept_columns = [*keys, *gate_columns] + [c for c in ("created_at",) if c in target.columns]
    known = _reachable(target.select(*kept_columns, F.lit(True).alias("_known")), batch if reach is None else reach, keys).alias("t")
    joined = _unique(batch, keys).alias("b").join(known, on=[F.col(f"b.{k}") == F.col(f"t.{k}") for k in keys], how="left")
    is_new = F.col("t._known").isNull()
    wanted = joined.where(is_new | (gate.passes("t", "b") if gate else F.lit(True)))

    def value(name: str) -> Column:
        if name == "created_at" and name not in batch.columns:
            return F.coalesce(F.col("t.created_at"), now)
        if name == "updated_at":
            return now
        return F.col(f"b.{name}") if name in batch.columns else F.lit(None)

    return wanted.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def key_check(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``row_count, distinct_keys, repeated_keys, null_keys`` of a batch, what a merge would refuse."""
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    times = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
    return times.agg(
        F.coalesce(F.sum("_times"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if((F.col("_times") > 1) & ~has_null).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("_times"))), F.lit(0)).alias("null_keys"),
    )


def _unique(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch; reading it fails where a key is null or comes twice. It is shuffled by its keys once, for the count and the join
    with the target."""
    counted = batch.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    message = F.concat(F.lit("null or repeated key in the batch: "), F.to_json(F.struct(*keys)))
    checked = F.when(has_null | (F.col("_times") > 1), F.raise_error(message)).otherwise(F.col(keys[0]))
    return counted.select(*[checked.alias(c) if c == keys[0] else F.col(c) for c in batch.columns])


def _reachable(stored: DataFrame, batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored rows the batch can meet.

    A batch that is small next to the store is broadcast by its measured size, so the store is read and
    reduced in place; the join that follows then meets a small side and needs no shuffle of the store either.
    """
    return stored.join(batch.select(*columns), on=list(columns), how="left_semi")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    now: Column,
    gate: Gate | None = None,
    changed: DataFrame | None = None,
) -> DataFrame:
    """The target after the merge.

    Stored rows that stay are found by an anti join against the changed keys, so a batch that is small
    next to the target is broadcast by its measured size and the wide target rows are never shuffled. Both
    sides must hold each key once; a batch that does not makes the job fail. ``changed`` may hold an already
    written result of :func:`changed_rows`.
    """
    if changed is None:
        changed = changed_rows(target, batch, keys, now, gate)
    untouched = target.join(changed.select(*keys), on=list(keys), how="left_anti").select(*target.columns)
    return untouched.unionByName(changed)


def not_stored_yet(batch: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Batch rows whose combination of columns is not among the stored rows."""
    seen = _reachable(stored.select(*columns), batch, columns)
    return batch.join(seen, on=list(columns), how="left_anti").select(*batch.columns)


def merge_statement(
    table: str, source: str, columns: Sequence[str], keys: Sequence[str], now: str, gate: Gate | None = None
) -> str:
    """The same merge as one SQL statement, for tables whose format changes rows in place.

    ``columns`` are those of the source; the table may have ``created_at`` and ``updated_at`` besides.
    """
    match = " AND ".join(f"t.{k} = b.{k}" for k in keys)
    only_changed = f" AND ({gate.sql('t', 'b')})" if gate else ""
    updates = ", ".join([f"{c} = b.{c}" for c in columns if c not in keys] + [f"updated_at = {now}"])
    names = ", ".join([*columns, "created_at", "updated_at"])
    values = ", ".join([*[f"b.{c}" for c in columns], now, now])
    return (
        f"MERGE INTO {table} AS t USING {source} AS b ON {match} "
        f"WHEN MATCHED{only_changed} THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def merge_into(batch: DataFrame, table: str, keys: Sequence[str], gate: Gate | None = None) -> None:
    """Merge a batch into a catalog table whose provider supports ``MERGE``, such as Iceberg or Delta.

    Only the files that hold changed rows are rewritten, where :func:`upsert` produces the whole table.
    """
    view = f"merge_batch_{uuid.uuid4().hex}"
    batch.createOrReplaceTempView(view)
    try:
        batch.sparkSession.sql(merge_statement(table, view, batch.columns, keys, "current_timestamp()", gate))
    finally:
        batch.sparkSession.catalog.dropTempView(view)
