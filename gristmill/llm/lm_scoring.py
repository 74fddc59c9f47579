"""Language-model scoring by context-tree weighting over bytes.

Training: each block of documents reduces its text to distinct grams (``depth`` context bytes and the next byte) with
counts. Grams meet by the three nearest context bytes, so that each shard owns whole subtrees below depth three, grows
them bottom up and reports what the shallower nodes need: sums per node of depth two, of which there are at most
256² contexts x 255 bit prefixes whatever the corpus. Scoring: shards answer each block's distinct grams with their
log-probabilities, and the block adds them up by document.

The modelled sequence is the one the token baseline sees: A-Z in lower case, words joined by one blank, then an end
symbol (a line feed, which no word can hold). Contexts start with end symbols.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm import blocks
from gristmill.llm import context_tree as tree
from gristmill.llm.common import (
    Lookup,
    expand,
    map_groups,
    map_rows,
    materialize,
    pack,
    pack_sorted,
    prepare,
    shards_for,
    squeeze,
    table,
    unpack,
    unpack_sorted,
)

DEPTH = 5
SHARD_DEPTH = 3
SHARD_BYTES = 32 << 20
END = b"\n"
_CHUNK = 2 << 20


def grams_of(texts: list[bytes], depth: int) -> np.ndarray:
    """Grams of all positions of the documents in order, the end symbol of each included."""
    gap = END * depth
    buffer = np.frombuffer(gap + b"".join(t + END + gap for t in texts), np.uint8)
    n = len(buffer) - depth
    grams = np.zeros(n, np.uint64)
    for back in range(1, depth + 1):
        grams <<= np.uint64(8)
        grams |= buffer[depth - back : depth - back + n]
    grams <<= np.uint64(8)
    grams |= buffer[depth:]
    lengths = np.empty(2 * len(texts), np.int64)
    lengths[0::2], lengths[1::2] = [len(t) + 1 for t in texts], depth
    return grams[np.repeat(np.arange(2 * len(texts)) % 2 == 0, lengths)[:n]]


def score(
    docs: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    depth: int = DEPTH,
    block_bytes: int = blocks.BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """A row per document: ``id_column``, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    ``learn`` says which rows train the model (null: they do); every row is scored. ``base_score`` is the add-half
    unigram score of the same tokens. Null and empty texts have the end token only. Rows with equal or null ids each
    give a row. Other columns are ignored. An empty table gives an empty result; without training rows every bit costs
    one bit. ``depth`` is at most 7.
    """
    spark = prepare(docs.sparkSession)
    if not SHARD_DEPTH <= depth <= 7:
        raise ValueError(f"depth must be from {SHARD_DEPTH} to 7")
    cut = blocks.cut(docs, id_column, text_column, lower=True, learn=learn, block_bytes=block_bytes)
    shards = shards_for(cut.agg(F.sum("n_bytes")).first()[0] or 0, shard_bytes, 8)

    def ask(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            yield from _requests(row, depth, shards)

    asked = "block bigint, shard int, grams binary, counts binary, words binary, word_counts binary"
    requests = materialize(map_rows(cut.select("block", "learn", "ends", "text"), ask, asked), "requests")

    def build(shard: int, rows: Iterator[dict]) -> Iterator[dict]:
        yield _subtrees(shard, rows, depth)

    built = (
        "shard int, asked binary, keys array<binary>, shares array<binary>, estimates array<binary>, words binary, word_counts binary, "
        "tokens bigint, distinct_words bigint, top array<struct<node:bigint, zeros:double, ones:double, below:double>>"
    )
    model = materialize(map_groups(requests.drop("block"), "shard", shards, build, built, place=F.col("shard")), "tree")
    n, v = model.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct_words"), F.lit(0))).first()
    top = _top_levels(model)

    answering = requests.select("shard", F.lit(1).alias("turn"), "block", "grams", "words").unionByName(
        model.select("shard", F.lit(0).alias("turn"), "asked", "keys", "shares", "estimates", "words", "word_counts"), allowMissingColumns=True
    )

    def answer(shard: int, rows: Iterator[dict]) -> Iterator[dict]:
        yield from _answers(rows, depth, top)

    answered = "block bigint, grams binary, bits binary, words binary, word_counts binary"
    answers = map_groups(answering, "shard", shards, answer, answered, ("turn",), F.col("shard"))
    meeting = answers.withColumn("turn", F.lit(0)).unionByName(cut.withColumn("turn", F.lit(1)), allowMissingColumns=True)

    def add_up(block: int, rows: Iterator[dict]) -> Iterator[dict]:
        yield from _document_scores(rows, depth, n, v)

    scored = "id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"
    return map_groups(meeting, "block", shards, add_up, scored, ("turn",), blocks.place(cut)).withColumnRenamed("id", id_column)


def _requests(row: dict, depth: int, shards: int) -> Iterator[dict]:
    """A block's distinct grams and words with their training counts, by the shard that owns them."""
    texts, learn = blocks.texts_of(row), np.array(row["learn"], bool)
    parts = []
    for first, some in blocks.chunks(texts, _CHUNK):
        grams = grams_of(some, depth)
        weight = np.repeat(learn[first : first + len(some)], [len(t) + 1 for t in some])
        for kept, counted in ((weight, 1), (~weight, 0)):
            distinct, n = np.unique(grams[kept], return_counts=True)
            parts.append((distinct, n * counted))
    grams, counts = tree.summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    words: Counter = Counter()
    for text, used in zip(texts, learn.tolist()):
        found = text.split()
        if used:
            words.update(found)
        else:
            words.update(dict.fromkeys(found, 0))
    words[END] = int(learn.sum())
    by_shard: list[list[bytes]] = [[] for _ in range(shards)]
    for word in words:
        by_shard[_word_shard(word, shards)].append(word)
    owner = _gram_shards(grams, depth, shards)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(shards + 1))
    for shard in range(shards):
        mine = order[edges[shard] : edges[shard + 1]]
        own = by_shard[shard]
        if len(mine) or own:
            yield {
                "block": row["block"],
                "shard": shard,
                "grams": pack_sorted(grams[mine]),
                "counts": pack(counts[mine].astype(np.int64)),
                "words": squeeze(b" ".join(own)) if own else None,
                "word_counts": pack(np.array([words[w] for w in own], np.int64)),
            }


def _gram_shards(grams: np.ndarray, depth: int, shards: int) -> np.ndarray:
    near = grams >> np.uint64(8 * (depth + 1 - SHARD_DEPTH))
    return ((near + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(shards)


def _word_shard(word: bytes, shards: int) -> int:
    return crc32(word) % shards


def _words(data: bytes | None) -> list[bytes]:
    return expand(data).split(b" ") if data is not None else []


def _subtrees(shard: int, rows: Iterator[dict], depth: int) -> dict:
    """The shard's subtrees and word counts; blocks are merged as they come, so memory follows the distinct grams."""
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held, size, words = [], 0, Counter()
    for row in rows:
        g, c = unpack_sorted(row["grams"]), unpack(row["counts"], np.int64)
        held.append((g, c))
        size += len(held[-1][0])
        if size > max(1 << 20, len(grams)):
            grams, counts = _merged(grams, counts, held)
            held, size = [], 0
        for word, count in zip(_words(row["words"]), unpack(row["word_counts"], np.int64).tolist()):
            if count:
                words[word] += count
    grams, counts = _merged(grams, counts, held)
    trained = counts > 0
    levels = tree.grow(grams[trained], counts[trained].astype(np.float64), depth, SHARD_DEPTH)
    shallow = levels[-1]
    top = tree.parents(shallow.keys, shallow.zeros, shallow.ones, shallow.log_weighted)
    return {
        "shard": shard,
        "asked": pack_sorted(grams),
        "keys": [pack_sorted(x.keys) for x in levels],
        "shares": [pack(x.share) for x in levels],
        "estimates": [pack(x.estimate) for x in levels],
        "words": squeeze(b" ".join(words)) if words else None,
        "word_counts": pack(np.fromiter(words.values(), np.int64, len(words))),
        "tokens": sum(words.values()),
        "distinct_words": len(words),
        "top": [dict(zip(("node", "zeros", "ones", "below"), x)) for x in zip(*(a.tolist() for a in top))],
    }


def _merged(grams: np.ndarray, counts: np.ndarray, held: list) -> tuple[np.ndarray, np.ndarray]:
    return tree.summed(np.concatenate([grams, *(h[0] for h in held)]), np.concatenate([counts, *(h[1] for h in held)]))


def _top_levels(model: DataFrame) -> dict[int, tuple]:
    """Levels 0 to 2 from the sums of all shards; at most 256² x 255 nodes, whatever the corpus."""
    nodes = model.select(F.inline("top")).groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).toPandas()
    nodes = nodes.sort_values("node")
    keys, zeros, ones, below = (nodes.iloc[:, i].to_numpy() for i in range(4))
    level = tree.Level(keys.astype(np.uint64), zeros.astype(float), ones.astype(float), below.astype(float))
    out = {}
    for depth in range(SHARD_DEPTH - 1, -1, -1):
        out[depth] = (level.keys, level.share, level.estimate)
        level = level.above()
    return out


def _answers(rows: Iterator[dict], depth: int, top: dict[int, tuple]) -> Iterator[dict]:
    """Log-probabilities and word counts for each block's request; the shard's model is the first row.

    Each distinct gram of the shard is scored once, blocks only look theirs up.
    """
    levels, counts = dict(top), {}
    for row in rows:
        if row["turn"] == 0:
            for i, (k, s, e) in enumerate(zip(row["keys"], row["shares"], row["estimates"])):
                levels[depth - i] = (unpack_sorted(k), unpack(s, np.float32), unpack(e, np.float32))
            counts = dict(zip(_words(row["words"]), unpack(row["word_counts"], np.int64).tolist()))
            grams = unpack_sorted(row["asked"])
            parts = [tree.log2_probability(grams[i : i + _CHUNK], depth, levels) for i in range(0, len(grams), _CHUNK)]
            scored = Lookup(grams, np.concatenate(parts or [np.zeros(0)]).astype(np.float32))
            continue
        bits = scored.get(unpack_sorted(row["grams"]))
        known = np.array([counts.get(w, 0) for w in _words(row["words"])], np.int64)
        yield {"block": row["block"], "grams": row["grams"], "bits": pack(bits), "words": row["words"], "word_counts": pack(known)}


def _document_scores(rows: Iterator[dict], depth: int, n: int, v: int) -> Iterator[dict]:
    grams, bits, counts = [], [], {}
    for row in rows:
        if row["turn"] == 0:
            grams.append(unpack_sorted(row["grams"]))
            bits.append(unpack(row["bits"], np.float32))
            counts.update(zip(_words(row["words"]), unpack(row["word_counts"], np.int64).tolist()))
            continue
        lookup = Lookup(np.concatenate(grams), np.concatenate(bits))
        logs = {w: math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for w, c in counts.items()}
        unknown = {w for w, c in counts.items() if not c}
        texts = blocks.texts_of(row)
        for first, some in blocks.chunks(texts, _CHUNK):
            lengths = np.array([len(t) + 1 for t in some])
            cost = lookup.get(grams_of(some, depth)).astype(np.float64)
            sums = np.add.reduceat(cost, np.concatenate(([0], np.cumsum(lengths)[:-1])))
            for i, text in enumerate(some):
                words = text.split()
                words.append(END)
                yield {
                    "id": row["ids"][first + i],
                    "n_tokens": len(words),
                    "n_known": len(words) - sum(map(unknown.__contains__, words)),
                    "train_tokens": n,
                    "base_score": math.fsum(map(logs.__getitem__, words)),
                    "score": float(sums[i]) * math.log10(2),
                    "n_bytes": int(lengths[i]),
                    "bits_per_byte": float(-sums[i] / lengths[i]),
                }


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    scored = score(docs, remainder != 1)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return scored.withColumn("held_out", held)
