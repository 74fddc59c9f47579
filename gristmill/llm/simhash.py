"""Near-duplicates by SimHash fingerprints, found with anchor points.

Anchors are the codewords of the binary Golay code of length 23, which covers every 23-bit word within distance 3. A
fingerprint's home is the one anchor within that radius of its lowest 23 bits; it is replicated to every anchor within
radius plus threshold (6), about 71 of 4,096. If two fingerprints differ in at most 3 bits, each is replicated to the
other's home, so comparing each anchor's homes with what was replicated there loses no link. For very many
fingerprints a second code over the next 23 bits shares the threshold with the first: about 300 of 16.8 million
anchors. The result is the same, only the balance of replicas and comparisons changes.

Equal fingerprints are one class from the start, so groups of copies cost nothing here.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.llm.common import map_rows, materialize, prepare, table
from gristmill.llm.components import components

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Above so many distinct fingerprints two codes are used.
ONE_CODE_UP_TO = 1 << 22
_LENGTH, _RADIUS = 23, 3
#: Fixed value: the generator polynomial of the Golay code.
_GENERATOR = 0b101011100011
_TILE = 1 << 21


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the hashes of the text's word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(joined, SEED)
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - size + 1)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * set_bits > len(hashes)).tolist())


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, print): the fingerprint as a signed 64-bit number; null and empty texts have zero. Ids are numbers or structs."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            value = fingerprint((row["text"] or "").encode(), size)
            yield {"id": row["id"], "print": value - (1 << 64) if value >> 63 else value}

    kind = docs.schema[id_column].dataType
    id_type = kind.simpleString() if isinstance(kind, T.StructType) else "bigint"
    narrow = docs.select(F.col(id_column).cast(id_type).alias("id"), F.col(text_column).alias("text"))
    return map_rows(narrow, run, f"id {id_type}, print bigint")


@lru_cache(maxsize=1)
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, error patterns by (syndrome, weight), and where each budget ends."""

    def remainder(word: int) -> int:
        for bit in range(_LENGTH - 1, 10, -1):
            if word >> bit & 1:
                word ^= _GENERATOR << (bit - 11)
        return word

    low = np.array([remainder(w) for w in range(1 << 12)], np.int64)
    high = np.array([remainder(w << 12) for w in range(1 << 11)], np.int64)
    patterns = np.array(
        [sum(1 << b for b in bits) for w in range(_RADIUS + THRESHOLD + 1) for bits in combinations(range(_LENGTH), w)], np.int64
    )
    syndrome = low[patterns & 4095] ^ high[patterns >> 12]
    weight = np.bitwise_count(patterns).astype(np.int64)
    order = np.lexsort((weight, syndrome))
    patterns, syndrome, weight = patterns[order], syndrome[order], weight[order]
    begin = np.searchsorted(syndrome, np.arange(1 << 11))
    excess = np.maximum(weight - _RADIUS, 0)
    until = np.stack([np.bincount(syndrome[excess <= b], minlength=1 << 11) for b in range(THRESHOLD + 1)], axis=1)
    return low, high, np.stack([patterns, excess]), np.concatenate([begin[:, None], until], axis=1)


def anchors(prints: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in prints, anchor, home) of every replica."""
    low, high, patterns, ranges = _code()
    which = np.arange(len(prints))
    anchor, spent = np.zeros(len(prints), np.int64), np.zeros(len(prints), np.int64)
    for code in range(codes):
        word = (prints[which] >> np.uint64(_LENGTH * code) & np.uint64((1 << _LENGTH) - 1)).astype(np.int64)
        syndrome = low[word & 4095] ^ high[word >> 12]
        count = ranges[syndrome, 1 + THRESHOLD - spent]
        origin = np.repeat(np.arange(len(which)), count)
        step = np.arange(len(origin)) - np.repeat(np.cumsum(count) - count, count)
        pattern, excess = patterns[:, ranges[syndrome[origin], 0] + step]
        anchor = anchor[origin] | (word[origin] ^ pattern) << (_LENGTH * code)
        which, spent = which[origin], spent[origin] + excess
    return which, anchor, spent == 0


def replicas(classes: DataFrame, codes: int) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("print", pa.int64()), ("home", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(prints), 1000):
                part = prints[at : at + 1000]
                which, anchor, home = anchors(part, codes)
                # A replica at its home is the home itself; others within the radius do not exist: the code is perfect.
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[which].view(np.int64)), pa.array(home)], schema=schema)

    return classes.select("print").mapInArrow(run, "anchor bigint, print bigint, home boolean")


def links(dealt: DataFrame) -> DataFrame:
    """Edges (a, b) that span the links between prints; a clique of n gives about n edges, not n²."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, homes = None, np.zeros(0, np.uint64)
        for batch in batches:
            anchor = batch.column(0).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            home = batch.column(2).to_numpy(zero_copy_only=False)
            bounds = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1], [True])))
            found = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if anchor[start] != current:
                    current, homes = anchor[start], np.zeros(0, np.uint64)
                some = prints[start:end]
                mine = home[start:end]
                if mine.any():
                    homes = np.concatenate([homes, some[mine]])
                if len(homes):
                    found.extend(_spanning(homes, some))
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _spanning(homes: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    width = max(1, min(len(others), _TILE // min(len(homes), 2048)))
    for h in range(0, len(homes), 2048):
        left = homes[h : h + 2048]
        for o in range(0, len(others), width):
            right = others[o : o + width]
            near = np.bitwise_count(left[None, :] ^ right[:, None]) <= THRESHOLD
            near &= left[None, :] != right[:, None]
            row, column = np.nonzero(near)
            if not len(row):
                continue
            # The first home of each print, and homes that follow each other under one print.
            first = np.concatenate(([True], row[1:] != row[:-1]))
            yield right[row[first]], left[column[first]]
            chain = np.unique(column[1:][~first[1:]] * len(left) + column[:-1][~first[1:]])
            if len(chain):
                yield left[chain // len(left)], left[chain % len(left)]


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE) -> DataFrame:
    """A row per document: ``id_column``, print (signed 64-bit), component_id.

    Prints that differ in at most 3 bits are linked; a component's id is the smallest document id in it. Texts without
    words (null, empty) have print zero and are linked like any other. Rows with a null id get a component, but are
    never its name unless it has no other id. Repeated rows each give a row. Other columns are ignored; an empty table gives
    an empty result.
    """
    prepare(docs.sparkSession)
    prints = materialize(fingerprints(docs, id_column, text_column, size), "prints")
    classes = materialize(prints.groupBy("print").agg(F.min("id").alias("least")), "print-classes")
    codes = 1 if classes.count() <= ONE_CODE_UP_TO else 2
    dealt = replicas(classes, codes).repartition("anchor").sortWithinPartitions("anchor", F.desc("home"))
    found = components(links(dealt))
    named = classes.join(found.withColumnRenamed("node", "print"), "print", "left")
    named = materialize(named.select("print", "least", F.coalesce("component", "print").alias("component")), "print-components")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("print", "component_id")
    return prints.join(named, "print").select(F.col("id").alias(id_column), "print", "component_id")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
