"""What the operators of this subpackage share: session settings, word rules, and streaming over groups of rows."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gristmill.session import materialize, tune

#: The white space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
NOT_SPACE = re.compile(rb"[^\x20\x09-\x0D]+")

#: Arrow batches hold whole documents, so they are bounded in bytes well below a Python worker's memory.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Samples of a few thousand rows per group are cut in the tasks that read them.
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
}
#: A side that is broadcast has at most so many bytes, written as JSON.
BROADCAST_BYTES = 32 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of all operators here."""
    tune(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text as an array, never null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def hash128(value: Column, salt: str) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a value; together they identify it."""
    return F.xxhash64(value), F.xxhash64(F.lit(salt), value)


def shards_for(rows: int, per_shard: int, least: int) -> int:
    """Partitions that hold about ``per_shard`` units each."""
    return max(least, -(-rows // per_shard))


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcasting if its measured size allows it; else the planner joins it as it likes."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def first_keys(df: DataFrame, group: str, order: list[str], n: int, salts: int = 32) -> DataFrame:
    """(``group``, the columns of ``order``, place) of the ``n`` first distinct keys of each group, written to the shared folder.

    Only keys are ranked, so give hashes and fetch what they stand for by a join with the result. Repeated keys are one before they
    are ranked, and a group is ranked in ``salts`` shares first, of which each map task sends at most ``n`` keys: a group
    that holds most of the rows is no task's alone.
    """
    keys = df.select(group, *order).distinct().withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    share = Window.partitionBy(group, "salt").orderBy(*order)
    few = keys.withColumn("place", F.row_number().over(share)).where(F.col("place") <= n)
    whole = Window.partitionBy(group).orderBy(*order)
    ranked = few.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= n)
    return materialize(ranked.drop("salt"), "first-keys")


def pack(array: np.ndarray) -> bytes:
    """An array as compressed bytes; bytes of equal weight stand together, which suits sorted or small numbers."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit keys as compressed differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def worker_state(owner: str | None) -> types.ModuleType:
    """What a Python worker keeps between the tasks of one operator; a task of another operator starts afresh."""
    state = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks"))
    if getattr(state, "owner", None) != owner:
        vars(state).clear()
        _give_back()
        state.owner = owner
    return state


def _give_back() -> None:
    """Return freed memory to the system: the tasks of the next operator need it, also those of other workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # other C libraries give memory back by themselves


def map_rows(
    df: DataFrame, function: Callable[[Iterator[dict]], Iterable[dict]], schema: str, owner: str | None = None
) -> DataFrame:
    """Run a generator over the rows of each partition; rows arrive and leave in Arrow batches."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(owner)
        pending, size = [], 0
        for row in function(_rows(batches)):
            pending.append(row)
            size += sum(len(v) for v in row.values() if isinstance(v, (bytes, str, list)))
            if size >= 4 << 20 or len(pending) >= 5000:
                yield pa.RecordBatch.from_pylist(pending, schema=arrow)
                pending, size = [], 0
        if pending:
            yield pa.RecordBatch.from_pylist(pending, schema=arrow)
        # A worker that waits for its next task holds nothing that the tasks of others need.
        del pending
        _give_back()

    return df.mapInArrow(run, schema)


def map_groups(
    df: DataFrame,
    key: str,
    parts: int,
    function: Callable[[int, Iterator[dict]], Iterable[dict]],
    schema: str,
    order: tuple = (),
    place: Column | None = None,
) -> DataFrame:
    """Run a generator over the rows of each key, which stream by in order; no group has to fit into memory.

    Keys are dealt to ``parts`` tasks by hash, or by ``place``, a whole number that follows from the key: numbers without gaps
    give every task equally many keys.
    """

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for value, group in groupby(rows, lambda row: row[key]):
            yield from function(value, group)
            for _ in group:
                pass

    if place is None:
        dealt = df.repartition(parts, key)
    else:
        dealt = df.repartitionById(parts, F.pmod(place, F.lit(parts)).cast("int"))
    return map_rows(dealt.sortWithinPartitions(key, *order), run, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


class Lookup:
    """Values by unsigned 64-bit key in an open-addressing table, for many lookups."""

    _EMPTY = np.uint64(2**64 - 1)
    _FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, self._EMPTY)
        row = np.zeros(1 << bits, np.int64)
        left, place = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self._keys[place] == self._EMPTY
            row[place[free]] = left[free]
            won = free & (row[place] == left)
            self._keys[place[won]] = keys[left[won]]
            left, place = left[~won], (place[~won] + 1) & self._mask
        self._values = values[row] if len(keys) else np.zeros(1 << bits, values.dtype)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * self._FACTOR >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray, default=0) -> np.ndarray:
        place = self._home(keys)
        out = np.full(len(keys), default, self._values.dtype)
        left = np.arange(len(keys))
        while len(left):
            found = self._keys[place]
            hit = found == keys[left]
            out[left[hit]] = self._values[place[hit]]
            on = ~hit & (found != self._EMPTY)
            left, place = left[on], (place[on] + 1) & self._mask
        return out


__all__ = ["materialize"]
