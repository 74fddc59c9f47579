"""Exact removal of repeated word windows by level-wise doubling.

The window length is halved while it stays at or above ``least`` words; that gives the levels, shortest first. At each
level a block of documents sends the distinct hashes of its windows to the shards, which tell those that occur in
several documents. Windows of the next level are two repeated ones side by side, so text that repeats nowhere drops out
at the shortest length and later levels handle repeated text alone. The last level asks with 96 bits per window and
the block's smallest document, and the answer is whether a smaller document holds the window.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import blocks
from gristmill.llm.common import (
    Lookup,
    map_groups,
    map_rows,
    materialize,
    pack,
    pack_sorted,
    prepare,
    shards_for,
    table,
    unpack,
    unpack_sorted,
)

WINDOW = 50
LEAST = 16
SHARD_WORDS = 4 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def levels_of(window: int, least: int = LEAST) -> list[int]:
    """Window lengths, each at most twice the one before, ending at ``window``."""
    out = [window]
    while out[0] >= 2 * least:
        out.insert(0, -(-out[0] // 2))
    return out


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    z = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ right >> np.uint64(29)) * _M1
    z = (z ^ z >> np.uint64(30)) * _M1
    z = (z ^ z >> np.uint64(27)) * _M2
    return z ^ z >> np.uint64(31)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words; runs of powers of two are made from two halves."""
    out, width, start, taken = None, 1, words, 0
    while True:
        if length & width:
            if out is None:
                out = start
            else:
                n = len(out) - width
                out = _mix(out[: max(n, 0)], start[taken : taken + max(n, 0)])
            taken += width
        if taken == length or len(start) <= width:
            break
        start, width = _mix(start[:-width], start[width:]), 2 * width
    size = len(words) - length + 1
    return out[:size] if size > 0 else np.zeros(0, np.uint64)


class _Windows:
    """Windows of a block's documents: word hashes, each word's document, and the words left in it from there."""

    def __init__(self, row: dict, window: int):
        self.texts = blocks.texts_of(row)
        self.ids = np.array([np.iinfo(np.int64).max if i is None else i for i in row["ids"]], np.int64)
        digest, lanes, lengths = xxhash.xxh3_128_digest, [], []
        for text in self.texts:
            words = text.split()
            lengths.append(len(words))
            lanes.append(b"".join(map(digest, words)))
        pairs = np.frombuffer(b"".join(lanes), np.uint64).reshape(-1, 2)
        self.lanes = np.ascontiguousarray(pairs.T)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int64), self.lengths)
        left = self.starts[1:][self.doc] - np.arange(len(self.doc))
        self.left = np.where(self.lengths[self.doc] >= window, left, 0)

    def at(self, length: int) -> np.ndarray:
        """Starts of the windows of a length that lie in one document that is long enough for a whole window."""
        return np.flatnonzero(self.left >= length)

    def keys(self, length: int, lane: int = 0) -> np.ndarray:
        return window_hashes(self.lanes[lane], length)


def deduplicate(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    least: int = LEAST,
    block_bytes: int = blocks.BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """A row per document: ``id_column``, n_words, n_removed, text (kept words joined by one blank).

    A word goes if a window of ``window`` words around it also starts in a document with a smaller id. Windows are
    judged on the input. Repeats inside one document, or in rows with one id, stay. Null and empty texts have no
    words and an empty result; rows with a null id take part as a document larger than all others. Other columns are
    ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    cut = blocks.cut(docs, id_column, text_column, lower=False, block_bytes=block_bytes)
    total = cut.agg(F.sum("n_words")).first()[0] or 0
    shards = shards_for(total, shard_words, 8)
    lengths = levels_of(window, least)
    # Filter levels only need enough bits to keep chance repeats rare; the last level compares 96.
    bits = [min(64, max(24, int(total).bit_length() + 10))] * (len(lengths) - 1) + [64]
    answers, place = None, blocks.place(cut)
    for level, length in enumerate(lengths):
        last = length == window
        shorter = (lengths[level - 1], bits[level - 1]) if level else None

        def ask(block, rows, length=length, shorter=shorter, width=bits[level], last=last):
            yield from _requests(block, rows, window, length, shorter, width, shards, last)

        if answers is None:
            requests = map_rows(_meet(cut, None), lambda rows, ask=ask: chain.from_iterable(ask(r["block"], iter([r])) for r in rows), _ASKED)
        else:
            requests = map_groups(_meet(cut, answers), "block", shards, ask, _ASKED, ("turn",), place)
        tell = _tell_last if last else _tell
        answers = materialize(map_groups(requests, "shard", shards, tell, _TOLD, place=F.col("shard")), "repeated-windows")

    def finish(block: int, rows: Iterator[dict]) -> Iterator[dict]:
        yield from _kept(rows, window)

    done = "id bigint, n_words bigint, n_removed bigint, text string"
    return map_groups(_meet(cut, answers), "block", shards, finish, done, ("turn",), place).withColumnRenamed("id", id_column)


_ASKED = "block bigint, shard int, keys binary, several binary, checks binary, least binary"
_TOLD = "block bigint, yes binary, several binary"


def _meet(cut: DataFrame, answers: DataFrame | None) -> DataFrame:
    """The answers to a block, then the block."""
    texts = cut.select("block", F.lit(1).alias("turn"), "ids", "ends", "text")
    if answers is None:
        return texts
    return answers.withColumn("turn", F.lit(0)).unionByName(texts, allowMissingColumns=True)


def _collect(rows: Iterator[dict]) -> tuple[np.ndarray, np.ndarray, dict]:
    """Keys that repeat, keys several documents of the block share, and the block."""
    yes, several = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for row in rows:
        if row["turn"]:
            return np.concatenate(yes), np.concatenate(several), row
        yes.append(unpack_sorted(row["yes"]))
        several.append(unpack_sorted(row["several"]))
    raise ValueError("answers without their block")


def _in(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return Lookup(wanted, np.ones(len(wanted), bool)).get(keys, False)


def _requests(block, rows, window, length, shorter, width, shards, last) -> Iterator[dict]:
    yes, _, row = _collect(rows)
    windows = _Windows(row, window)
    starts = windows.at(length)
    if shorter:
        before, kept_bits = shorter
        repeated = np.zeros(len(windows.left) + 1, bool)
        at = windows.at(before)
        repeated[at] = _in(windows.keys(before)[at] >> np.uint64(64 - kept_bits), yes)
        starts = starts[repeated[starts] & repeated[starts + length - before]]
    keys = windows.keys(length)[starts] >> np.uint64(64 - width)
    ids = windows.ids[windows.doc[starts]]
    order = np.lexsort((ids, keys)) if last else np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return
    several = np.maximum.reduceat(ids, first) != np.minimum.reduceat(ids, first)
    checks = windows.keys(length, 1)[starts[order[first]]].astype(np.uint32) if last else None
    keys, smallest = keys[first], ids[first]
    # Equal ranges of the key space, one per shard.
    edges = np.searchsorted(keys, (np.arange(1, shards, dtype=object) * (1 << width) // shards).astype(np.uint64))
    edges = [0, *edges.tolist(), len(keys)]
    for shard in range(shards):
        part = slice(edges[shard], edges[shard + 1])
        if edges[shard] < edges[shard + 1]:
            yield {
                "block": block,
                "shard": shard,
                "keys": pack_sorted(keys[part]),
                "several": pack(np.packbits(several[part])),
                "checks": pack(checks[part]) if last else None,
                "least": pack(smallest[part]) if last else None,
            }


def _gathered(rows: Iterator[dict]) -> tuple[list[int], list[np.ndarray], list[np.ndarray], list[dict]]:
    names, keys, several, rest = [], [], [], []
    for row in rows:
        names.append(row["block"])
        keys.append(unpack_sorted(row["keys"]))
        several.append(np.unpackbits(unpack(row["several"], np.uint8), count=len(keys[-1])).astype(bool))
        rest.append((row["checks"], row["least"]))
    return names, keys, several, rest


def _told(block: int, yes: np.ndarray, several: np.ndarray) -> dict:
    return {"block": block, "yes": pack_sorted(yes), "several": pack_sorted(several)}


def _tell(shard: int, rows: Iterator[dict]) -> Iterator[dict]:
    """For each block its keys that several documents hold, anywhere."""
    names, keys, several, _ = _gathered(rows)
    together = np.sort(np.concatenate(keys))
    often = np.unique(np.concatenate([together[1:][together[1:] == together[:-1]], *(k[s] for k, s in zip(keys, several))]))
    table = Lookup(often, np.ones(len(often), bool))
    for block, k in zip(names, keys):
        if (yes := table.get(k, False)).any():
            yield _told(block, k[yes], np.zeros(0, np.uint64))


def _tell_last(shard: int, rows: Iterator[dict]) -> Iterator[dict]:
    """For each block its keys that a document smaller than all of the block's holds, and those only its own share."""
    names, keys, several, rest = _gathered(rows)
    checks = [unpack(c, np.uint32) for c, _ in rest]
    least = [unpack(m, np.int64) for _, m in rest]
    key, check, smallest = np.concatenate(keys), np.concatenate(checks), np.concatenate(least)
    order = np.lexsort((smallest, check, key))
    key, check, smallest = key[order], check[order], smallest[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])))
    winner = np.empty(len(key), np.int64)
    winner[order] = smallest[np.flatnonzero(new)][np.cumsum(new) - 1]
    start = 0
    for block, k, s, m in zip(names, keys, several, least):
        yes = winner[start : start + len(k)] < m
        start += len(k)
        if yes.any() or s.any():
            yield _told(block, k[yes], k[s & ~yes])


def _kept(rows: Iterator[dict], window: int) -> Iterator[dict]:
    yes, several, row = _collect(rows)
    windows = _Windows(row, window)
    starts = windows.at(window)
    keys = windows.keys(window)[starts]
    covered = _in(keys, yes)
    inside = np.flatnonzero(_in(keys, several))
    if len(inside):
        ids = windows.ids[windows.doc[starts[inside]]]
        order = np.lexsort((ids, keys[inside]))
        sorted_keys = keys[inside][order]
        new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
        covered[inside[order]] = ids[order] > ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    marks = np.zeros(len(windows.left) + 1, np.int64)
    np.add.at(marks, starts[covered], 1)
    np.add.at(marks, starts[covered] + window, -1)
    gone = np.cumsum(marks)[:-1] > 0
    for i, text in enumerate(windows.texts):
        here = gone[windows.starts[i] : windows.starts[i + 1]]
        removed = int(here.sum())
        if removed:
            text = b" ".join(w for w, g in zip(text.split(), here.tolist()) if not g)
        yield {"id": row["ids"][i], "n_words": len(here), "n_removed": removed, "text": text.decode()}


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    done = deduplicate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
