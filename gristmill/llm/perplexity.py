"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Trigrams (u, v, w) of all documents meet by their middle word v, those the model learns from and those it is asked about together, so
trigram counts, bigrams (v, w) with their continuation counts and both kinds of context are complete in a shard, and the model itself never
travels. A middle word with more than a shard's share of the words is dealt over several shards by w.

Two passes are made. The first sends every shard its distinct trigrams with counts. Counts that go beyond a shard are summed by key and
returned to the shards that asked: in how many bigrams a word is second, and the contexts v and (u, v) of the middle words that are dealt over
several shards. The second pass sends the trigrams again, now with the documents that hold them; a shard adds up its share of each document's
log probability. It is made in rounds over the shards, so that the disk holds one round's trigrams.

Documents are kept if their perplexity is not above a high quantile of trusted texts of their language that the model did not learn
from. There is no lower bound: the texts the model learned from, and copies of them, are far below all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import Lookup, map_groups, map_rows, materialize, pack, pack_sorted, prepare, shards_for
from gristmill.llm.common import small, table, unpack, unpack_sorted
from gristmill.session import scratch

QUANTILE = 0.998
#: Room above the quantile in log10 of perplexity, for short texts.
MARGIN = 0.25
BLOCK_BYTES = 16 << 20
#: Bytes of text per shard: of what the model learns from, and of all documents.
MODEL_BYTES, SHARD_BYTES = 16 << 20, 16 << 20
#: Rounds of the second pass.
ROUNDS = 3
#: Bytes of text in which the words are counted that are dealt over several shards. Results do not depend on it.
DEALING_BYTES = 64 << 20
#: Whether what a query shuffled is removed at its end and not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BEGIN, _END = "\n", "\t"  # no word can hold them
#: Bits of a word's hash. A word meets one of a hundred million others by chance once in three million times.
_WORD_BITS = 48
#: Ids of words of a block or shard that fit three times into a number.
_ID_BITS = 21
_P1, _P2, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_P3 = np.uint64(0x165667B19E3779F9)


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def xxhash64_of_long(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 8-byte numbers, as the SQL function xxhash64 chains it over columns."""
    h = seed + _P5 + np.uint64(8)
    h = _rotate(h ^ _rotate(values * _P2, 31) * _P1, 27) * _P1 + _P4
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


def _word(word: str | bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42) >> (64 - _WORD_BITS)


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and more, from the numbers of n-grams counted 1 to 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    raw = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.array([min(max(d, 0.05), i - 0.05) if i else 0.0 for i, d in enumerate(raw)])


def _of(discounts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return discounts[np.minimum(counts, 3)]


def _of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _mix(keys: np.ndarray) -> np.ndarray:
    h = keys * _P1
    h = (h ^ h >> np.uint64(32)) * _P2
    return h ^ h >> np.uint64(29)


class _Dealer:
    """The shard of every trigram: that of its middle word, or one of several by its last word."""

    def __init__(self, shards: int, hot: dict[int, int]):
        self.shards = shards
        self._hot = Lookup(np.array(list(hot), np.uint64), np.array(list(hot.values()), np.int64))

    def spread(self, words: np.ndarray) -> np.ndarray:
        """How many shards share each middle word."""
        return self._hot.get(words, 1)

    def places(self, words: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of every trigram's middle word, and of every place the word and the shard; shards ascend, and words inside them."""
        spread = self.spread(words)
        start = np.cumsum(spread) - spread
        word = np.repeat(np.arange(len(words), dtype=np.int32), spread)
        turn = np.arange(len(word)) - start[word]
        home = (_mix(words) % np.uint64(self.shards)).astype(np.int64)
        shard = (home[word] + turn) % self.shards
        order = np.argsort(shard, kind="stable")
        rank = np.empty(len(word), np.int32)
        rank[order] = np.arange(len(word))
        if len(word) == len(words):
            return rank[v], word[order], shard[order]
        last = (_mix(words ^ _P5) >> np.uint64(8)).astype(np.int64)
        return rank[start[v] + last[w] % spread[v]], word[order], shard[order]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate((np.ones(min(len(values), 1), bool), values[1:] != values[:-1]))]


def _key(v: np.ndarray, w: np.ndarray, u: np.ndarray) -> np.ndarray:
    return v.astype(np.uint64) << np.uint64(2 * _ID_BITS) | w.astype(np.uint64) << np.uint64(_ID_BITS) | u.astype(np.uint64)


def _ordered(v: np.ndarray, w: np.ndarray, u: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of trigrams by v, w and u, and where in it a new trigram begins."""
    if words < 1 << _ID_BITS:
        key = _key(v, w, u)
        order = np.argsort(key)
        return order, _changes(key[order])
    order = np.lexsort((u, w, v))
    return order, _changes(v[order], w[order], u[order])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """The rows of sorted columns that differ from the row before."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """The number of each row's group among rows sorted by these columns."""
    group = np.zeros(len(columns[0]), np.int64)
    group[_changes(*columns)] = 1
    return np.cumsum(group) - 1


def _stretches(owner: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, begin, end) of every shard that owns any of what is sorted by shard."""
    cuts = np.searchsorted(owner, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        yield s, int(cuts[s]), int(cuts[s + 1])


class _Block:
    """Some documents as trigrams of word ids, which number the block's words by their hash."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        texts = pa.array([r["text"] or "" for r in rows], pa.large_string())
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
        coded = pc.dictionary_encode(split.flatten())
        spelled = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        ids = coded.indices.to_numpy()
        document = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(split.offsets.to_numpy()))
        empty = np.flatnonzero(spelled == b"")  # a text without words is split into one empty word
        if len(empty):
            real = ids != empty[0]
            ids, document = ids[real], document[real]
        self.lengths = np.bincount(document, minlength=len(rows))
        hashes = np.array([_word(x) for x in spelled.tolist()] + [_word(_BEGIN), _word(_END)], np.uint64)
        order = np.argsort(hashes)
        place = np.empty(len(hashes), np.int32)
        first = np.concatenate(([True], np.diff(hashes[order]) > 0))
        place[order] = np.cumsum(first) - 1
        self.words = hashes[order][first]
        # Every document is two begins, its words and an end.
        ends = np.cumsum(self.lengths + 3) - 1
        line = np.full(len(ids) + 3 * len(rows), place[-2], np.int32)
        line[np.arange(2, len(ids) + 2) + 3 * document.astype(np.int64)] = place[ids]
        line[ends] = place[-1]
        inside = np.ones(max(len(line) - 2, 0), bool)
        inside[ends[:-1]] = inside[ends[:-1] - 1] = False
        self.u, self.v, self.w = line[:-2][inside], line[1:-1][inside], line[2:][inside]
        self.document = np.repeat(np.arange(len(rows), dtype=np.int32), self.lengths + 1)

    def dealt(self, dealer: _Dealer, pairs: bool, round_: int = 0, rounds: int = 1) -> Iterator[dict]:
        """Distinct trigrams by shard with how often the model learns from them, and with ``pairs`` the documents that ask for them."""
        # A middle word has a place for every shard that shares it; places ascend with the shards.
        middle, of_v, shard_of = dealer.places(self.words, self.v, self.w)
        u, w, doc = self.u, self.w, self.document
        if rounds > 1:
            mine = (shard_of % rounds == round_)[middle]
            u, w, doc, middle = u[mine], w[mine], doc[mine], middle[mine]
        learn = np.array([r["learn"] for r in self.rows], bool)
        asked = np.array([r["asked"] for r in self.rows], bool)
        size = max(len(self.words), len(of_v))
        if not pairs and size < 1 << _ID_BITS:
            key = np.sort(_key(middle, w, u) << np.uint64(1) | learn[doc])
            learnt, key = key & np.uint64(1), key >> np.uint64(1)
            first = _changes(key)
            middle, w, u = (key[first] >> np.uint64(x * _ID_BITS) & np.uint64((1 << _ID_BITS) - 1) for x in (2, 1, 0))
        else:
            order, first = _ordered(middle, w, u, size)
            doc, at = doc[order], order[first]
            u, w, middle, learnt = u[at], w[at], middle[at], learn[doc]
        ends = np.append(first, len(doc))
        c = np.diff(np.concatenate(([0], np.cumsum(learnt.astype(np.int64))))[ends])
        v, w, u, shard = of_v[middle], w.astype(np.int32), u.astype(np.int32), shard_of[middle]
        if pairs:
            kept = asked[doc]
            ends = np.concatenate(([0], np.cumsum(kept)))[ends]
            doc = doc[kept]
        hot = dealer.spread(self.words) > 1
        flags, place = np.zeros(len(self.words), bool), np.zeros(len(self.words), np.int32)
        for s, a, b in _stretches(shard, dealer.shards):
            whole = slice(a, b) if pairs else a + np.flatnonzero((c[a:b] > 0) | hot[v[a:b]])
            x, y, z = u[whole], v[whole], w[whole]
            if (b - a) * 8 > len(flags):
                for ids in (x, y, w[a:b]):
                    flags[ids] = True
                own = np.flatnonzero(flags)
            else:
                own = _distinct(np.concatenate((x, y, w[a:b])))
            place[own] = np.arange(len(own))
            flags[own] = False
            row = {"shard": s, "words": pack_sorted(self.words[own]), "u": pack(place[x].astype(np.uint32)), "w": pack(place[z].astype(np.uint32))}
            # Middle words ascend.
            row |= {"v": pack(np.diff(place[y], prepend=0).astype(np.uint32)), "c": pack(c[whole].astype(np.uint32))}
            if pairs:
                holders = doc[ends[a] : ends[b]].astype(np.uint32)
                row |= {"per": pack(np.diff(ends[a : b + 1]).astype(np.uint32)), "docs": pack(holders)}
            else:
                follows = np.zeros(len(own), bool)
                follows[place[w[a:b]]] = True
                row["follows"] = np.packbits(follows).tobytes()
            yield row

    def number(self) -> int:
        """The block's name, which follows from all it holds: rounds that cut the documents differently do not pass for each other."""
        h = xxhash.xxh64(repr([(r["id"], r["lang"], r["learn"], r["trusted"]) for r in self.rows]))
        for part in (self.words, self.u, self.v, self.w, self.document):
            h.update(part.tobytes())
        return ((TaskContext.get().partitionId() << 40) | (h.intdigest() >> 24)) & (2**63 - 1)


_POSTED = "shard int, words binary, u binary, v binary, w binary, c binary, follows binary"


def _blocks(rows: Iterator[dict], block_bytes: int) -> Iterator[_Block]:
    held, size = [], 0
    for row in rows:
        n = len((row["text"] or "").encode())
        if held and size + n > block_bytes:
            yield _Block(held)
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield _Block(held)


class _Shard:
    """The distinct trigrams of a shard in the order of v, w and u, with what follows from their counts.

    ``asks`` are the keys whose sums over all shards the shard needs, in a fixed order: words, and contexts of middle words that
    several shards share.
    """

    def __init__(self, posted: list[dict], dealer: _Dealer):
        named = [unpack_sorted(r["words"]) for r in posted]
        self.words = _distinct(np.concatenate(named))
        follows, parts = np.zeros(len(self.words), bool), []
        for row, own in zip(posted, named):
            place = np.searchsorted(self.words, own).astype(np.int32)
            ids = unpack(row["u"], np.uint32), np.cumsum(unpack(row["v"], np.uint32)), unpack(row["w"], np.uint32)
            parts.append([place[i] for i in ids] + [unpack(row["c"], np.uint32)])
            if row["follows"] is not None:
                follows[place[np.unpackbits(np.frombuffer(row["follows"], np.uint8), count=len(own)) > 0]] = True
        u, v, w, c = (np.concatenate(x) for x in zip(*parts))
        self.sizes = [len(p[0]) for p in parts]
        del parts, named
        order, first = _ordered(v, w, u, len(self.words))
        #: The trigram of every posted one.
        self.trigram = np.empty(len(order), np.int32)
        self.trigram[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(order))))
        self.c = np.add.reduceat(c[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        self.u, self.v, self.w = (x[order[first]] for x in (u, v, w))
        del u, v, w, c, order
        follows[self.w] = True
        self.pair = _groups(self.v, self.w)
        at = _changes(self.v, self.w)
        self.pair_v, self.pair_w = self.v[at], self.w[at]
        self.pair_c = np.bincount(self.pair, weights=self.c > 0, minlength=len(at)).astype(np.int64)
        # Contexts (u, v) by number, and v by word.
        key = self.v.astype(np.int64) * len(self.words) + self.u
        self.context_keys, self.context = np.unique(key, return_inverse=True)
        self.hot = dealer.spread(self.words) > 1
        self.asked_words = np.flatnonzero(follows)
        self.hot_v = np.flatnonzero(self.hot & (np.bincount(self.v, minlength=len(self.words)) > 0))
        self.hot_contexts = np.flatnonzero(self.hot[self.context_keys // len(self.words)])

    def sums_v(self) -> np.ndarray:
        return _tally(self.pair_v, self.pair_c, len(self.words))

    def sums_uv(self) -> np.ndarray:
        return _tally(self.context, self.c, len(self.context_keys))

    def asks(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(keys in order, contributions) of words and of shared contexts, and where in the shard they belong."""
        second = np.bincount(self.pair_w, weights=self.pair_c > 0, minlength=len(self.words))[self.asked_words]
        own = self.words[self.asked_words]
        keys_v = xxhash64_of_long(self.words[self.hot_v], np.full(len(self.hot_v), 1, np.uint64))
        u, v = (self.words[x[self.hot_contexts]] for x in (self.context_keys % len(self.words), self.context_keys // len(self.words)))
        keys_uv = xxhash64_of_long(v, xxhash64_of_long(u, np.full(len(u), 2, np.uint64)))
        keys = np.concatenate((keys_v, keys_uv))
        self.shared_order = np.argsort(keys, kind="stable")
        sums = np.concatenate((self.sums_v()[:, self.hot_v], self.sums_uv()[:, self.hot_contexts]), axis=1)
        return [(own << np.uint64(64 - _WORD_BITS), second[None, :]), (keys[self.shared_order], sums[:, self.shared_order])]

    def log10(self, answers: dict[int, np.ndarray], model: dict) -> np.ndarray:
        """log10 p(w | u, v) of every trigram."""
        c1 = np.zeros(len(self.words), np.int64)
        c1[self.asked_words] = answers[0][0]
        p1 = (c1 - _of(model["d1"], c1)) / model["total"] + model["rest"]
        by_v, by_uv = self.sums_v(), self.sums_uv()
        shared = np.empty((4, len(self.shared_order)))
        shared[:, self.shared_order] = answers[1]
        by_v[:, self.hot_v] = shared[:, : len(self.hot_v)]
        by_uv[:, self.hot_contexts] = shared[:, len(self.hot_v) :]
        p2 = _interpolated(self.pair_c, by_v, self.pair_v, model["d2"], p1[self.pair_w])
        return np.log10(_interpolated(self.c, by_uv, self.context, model["d3"], p2[self.pair]))


def _tally(group: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Per group: the sum of the counts and how many are 1, 2 and more."""
    return np.stack([np.bincount(group, weights=x, minlength=size) for x in (counts, counts == 1, counts == 2, counts > 2)])


def _interpolated(counts: np.ndarray, sums: np.ndarray, group: np.ndarray, discounts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The discounted share of each count in its context, and the rest of the context by the lower order."""
    total = sums[0]
    weight = np.divide(discounts[1:] @ sums[1:], total, out=np.ones(len(total)), where=total > 0)
    return (counts - _of(discounts, counts)) / np.maximum(total, 1)[group] + weight[group] * lower


def _owners(keys: np.ndarray, owners: int) -> np.ndarray:
    """Equal ranges of the key space."""
    return ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _learn(rows: DataFrame, dealer: _Dealer, block_bytes: int, keep) -> tuple[DataFrame, dict]:
    """The sums that shards asked for, (shard, kind, owner, sums), and the model's constants."""

    def post(found: Iterator[dict]) -> Iterator[dict]:
        for block in _blocks(found, block_bytes):
            yield from block.dealt(dealer, pairs=False)

    owners = max(min(dealer.shards, 8), dealer.shards // 4)

    def ask(shard: int, found: Iterator[dict]) -> Iterator[dict]:
        own = _Shard(list(found), dealer)
        counted = {"n3": _of_counts(own.c), "n2": _of_counts(own.pair_c)}
        for kind, (keys, sums) in enumerate(own.asks()):
            for o, a, b in _stretches(_owners(keys, owners), owners):
                numbers = pack(np.ascontiguousarray(sums[:, a:b]).astype(np.uint64).ravel())
                yield {"part": o * 2 + kind, "shard": shard, "keys": pack_sorted(keys[a:b]), "sums": numbers} | counted
                counted = {"n3": None, "n2": None}

    asked = "part bigint, shard int, keys binary, sums binary, n3 array<bigint>, n2 array<bigint>"
    posted = map_groups(map_rows(rows, post, _POSTED), "shard", dealer.shards, ask, asked, place=F.col("shard"))

    def add(part: int, found: Iterator[dict]) -> Iterator[dict]:
        held = [(r["shard"], unpack_sorted(r["keys"]), unpack(r["sums"], np.uint64)) for r in found]
        keys, place = np.unique(np.concatenate([k for _, k, _ in held]), return_inverse=True)
        lines = len(held[0][2]) // len(held[0][1])
        sums = np.zeros((lines, len(keys)), np.int64)
        at = np.cumsum([0] + [len(k) for _, k, _ in held])
        for i, (_, k, n) in enumerate(held):
            sums[:, place[at[i] : at[i + 1]]] += n.reshape(lines, -1).astype(np.int64)
        c1 = [*_of_counts(sums[0]), int((sums[0] > 0).sum()), int(sums[0].sum()), int((sums[0] > 2).sum())] if part % 2 == 0 else None
        for i, (shard, *_) in enumerate(held):
            numbers = pack(np.ascontiguousarray(sums[:, place[at[i] : at[i + 1]]]).astype(np.uint64).ravel())
            yield {"shard": shard, "kind": part % 2, "owner": part // 2, "sums": numbers, "c1": c1 if i == 0 else None}

    with scratch(rows.sparkSession) as keep_here:
        asks = keep_here(posted, "asked-sums")
        n3, n2 = _totals(asks, "n3"), _totals(asks, "n2")
        summed = map_groups(asks.select("part", "shard", "keys", "sums"), "part", owners * 2, add, "shard int, kind int, owner int, sums binary, c1 array<bigint>", place=F.col("part"))
        answers = keep(summed, "summed")
    c1 = _totals(answers, "c1", 7)
    known, total, d1 = int(c1[4]), max(int(c1[5]), 1), _discounts(c1[:4])
    taken = float(d1[1:] @ np.array([c1[0], c1[1], c1[6]]))
    # The words that can follow others, numbered, and the bigrams they are in; the end is no word.
    model = {
        "d1": d1, "d2": _discounts(n2), "d3": _discounts(n3), "total": total, "rest": (taken / total if known else 1.0) / (known + 1),
        "words": (range(max(known - 1, 0)), int(c1[5])),
    }
    return answers.drop("c1"), model


def _totals(df: DataFrame, column: str, size: int = 4) -> np.ndarray:
    found = df.agg(*(F.sum(F.get(column, F.lit(i))) for i in range(size))).first()
    return np.array([float(x or 0) for x in found])


def _dealer(rows: DataFrame, size: int, shards: int) -> _Dealer:
    """Middle words that are more than a shard's share of a stretch of the documents go to as many shards."""

    def count(found: Iterator[dict]) -> Iterator[dict]:
        for block in _blocks(found, BLOCK_BYTES):
            n = np.bincount(block.v, minlength=len(block.words))
            often = np.flatnonzero(n * 4 * shards > len(block.v))
            for w, k in zip(block.words[often].tolist(), n[often].tolist()):
                yield {"word": w, "n": k, "tokens": None}
            yield {"word": None, "n": None, "tokens": len(block.v)}

    some = rows if size <= DEALING_BYTES else rows.sample(DEALING_BYTES / size, 7)
    counted = map_rows(some, count, "word bigint, n bigint, tokens bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))
    often = {r["word"]: (r["n"], r["tokens"]) for r in counted.collect()}
    _, tokens = often.pop(None, (0, 0))
    return _Dealer(shards, {w: min(-(-n * shards // tokens), shards) for w, (n, _) in often.items() if n * shards > tokens})


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Tables that are written in here leave no shuffle files behind."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _score(rows: DataFrame, block_bytes: int, dealer: _Dealer, rounds: int = ROUNDS) -> DataFrame:
    """(id, lang, learn, trusted, n_tokens, log10) of every row that is asked about, under the model of those to learn from."""
    with _shuffles_removed(rows.sparkSession), scratch(rows.sparkSession) as keep:
        answers, model = _learn(rows, dealer, block_bytes, keep)
        turns = answers.withColumn("turn", F.lit(0))
        sums = [materialize(_round(rows, turns, model, dealer, block_bytes, r, rounds), "log10") for r in range(rounds)]
    parts = sums[0]
    for more in sums[1:]:
        parts = parts.unionByName(more)

    def total(block: int, found: Iterator[dict]) -> Iterator[dict]:
        about, log10 = None, None
        for row in found:
            if row["about"] is not None:
                about, log10 = row["about"], np.zeros(len(row["about"]))
                continue
            if about is None:
                break
            np.add.at(log10, unpack(row["docs"], np.uint32), unpack(row["sums"], np.float64))
        if about is None:
            raise RuntimeError("the documents were cut into other blocks when they were read again")
        for a, x in zip(about, log10.tolist()):
            if a["asked"]:
                yield {k: a[k] for k in ("id", "lang", "learn", "trusted", "n_tokens")} | {"log10": x}

    return map_groups(parts, "block", dealer.shards, total, "id bigint, lang string, learn boolean, trusted boolean, n_tokens bigint, log10 double", ("turn",))


_ABOUT = "array<struct<id:bigint,lang:string,learn:boolean,trusted:boolean,asked:boolean,n_tokens:bigint>>"


def _round(rows: DataFrame, answers: DataFrame, model: dict, dealer: _Dealer, block_bytes: int, round_: int, rounds: int) -> DataFrame:
    """(block, turn, about, docs, sums): the shards' parts of the log probabilities, and what each block holds before them."""

    def post(found: Iterator[dict]) -> Iterator[dict]:
        for block in _blocks(found, block_bytes):
            number = block.number()
            if round_ == 0:
                about = [{k: r[k] for k in ("id", "lang", "learn", "trusted", "asked")} | {"n_tokens": n + 1} for r, n in zip(block.rows, block.lengths.tolist())]
                yield {"shard": number % dealer.shards, "turn": 2, "block": number, "about": about}
            for row in block.dealt(dealer, True, round_, rounds):
                yield row | {"turn": 1, "block": number}

    def add(shard: int, found: Iterator[dict]) -> Iterator[dict]:
        answered, posted = {0: [], 1: []}, []
        for row in found:
            if row["turn"] == 0:
                answered[row["kind"]].append(unpack(row["sums"], np.uint64))
            elif row["turn"] == 2:
                yield {"block": row["block"], "turn": 0, "about": row["about"]}
            else:
                posted.append(row)
        if not posted:
            return
        own = _Shard(posted, dealer)
        asks = own.asks()
        values = {}
        for kind, lines in ((0, 1), (1, 4)):
            values[kind] = np.concatenate([a.reshape(lines, -1) for a in answered[kind]] or [np.zeros((lines, 0))], axis=1).astype(np.float64)
            if values[kind].shape[1] != len(asks[kind][0]):
                raise RuntimeError("the documents changed while they were read again")
        values[0] = values[0].astype(np.int64)
        log10 = own.log10(values, model)
        at = 0
        for row, n in zip(posted, own.sizes):
            each = np.repeat(log10[own.trigram[at : at + n]], unpack(row["per"], np.uint32))
            sums = np.bincount(unpack(row["docs"], np.uint32).astype(np.int64), weights=each)
            docs = np.flatnonzero(sums)  # p is below 1, so documents that ask for anything have a sum
            at += n
            yield {"block": row["block"], "turn": 1, "docs": pack(docs.astype(np.uint32)), "sums": pack(sums[docs])}

    posted = _POSTED + f", per binary, docs binary, turn int, block bigint, about {_ABOUT}"
    mine = answers.where(F.pmod("shard", F.lit(rounds)) == round_)
    turns = map_rows(rows, post, posted).unionByName(mine, allowMissingColumns=True)
    # A round's shards are ``rounds`` apart.
    place, tasks = F.floor(F.col("shard") / rounds), -(-dealer.shards // rounds)
    return map_groups(turns, "shard", tasks, add, f"block bigint, turn int, about {_ABOUT}, docs binary, sums binary", ("turn", "kind", "owner"), place)


def _sharded(rows: DataFrame, model_bytes: int, shard_bytes: int) -> _Dealer:
    size = F.octet_length("text")
    size, learned = (x or 0 for x in rows.agg(F.sum(size), F.sum(F.when(F.col("learn"), size))).first())
    shards = max(shards_for(learned, model_bytes, 8), shards_for(size, shard_bytes, 8))
    return _dealer(rows, size, min(shards, 100_000))


def score(
    docs: DataFrame, sample: DataFrame, id_column: str, text_column: str, lang_column: str | None = None, block_bytes: int = BLOCK_BYTES,
    model_bytes: int = MODEL_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(id, lang, n_tokens, log10) of every document under the model of all texts of the sample; the end of a text is a token."""
    prepare(docs.sparkSession)
    no = F.lit(False)
    lang = F.lit(None) if lang_column is None else F.coalesce(lang_column, F.lit(""))
    asked = docs.select(
        F.col(id_column).cast("bigint").alias("id"), lang.cast("string").alias("lang"), F.col(text_column).alias("text"), no.alias("learn"),
        no.alias("trusted"), F.lit(True).alias("asked"),
    )
    rows = asked.unionByName(_to_learn(sample))
    scored = _score(rows, block_bytes, _sharded(rows, model_bytes, shard_bytes))
    return scored.select("id", "lang", "n_tokens", "log10")


def _to_learn(texts: DataFrame) -> DataFrame:
    yes, no = F.lit(True), F.lit(False)
    return texts.select(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("lang"), "text", yes.alias("learn"), yes.alias("trusted"), no.alias("asked"))


def train(texts: DataFrame, shards: int) -> tuple[DataFrame, dict]:
    """The sums over all shards that the shards of a model of the texts ask for, and the model's constants."""
    return _learn(_to_learn(texts), _Dealer(shards, {}), BLOCK_BYTES, materialize)


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(``id_column``, lang, n_tokens, log10, perplexity, high, kept) of every document.

    Trusted are the documents that ``labels`` call good (quality 1) and not toxic (toxic 0) in every row about them. The model learns from
    four fifths of them, whole, dealt by a hash of text and id; the quantile is taken over all other trusted documents of the language, or over all
    languages together where there are none. Perplexity is per token, the end included. Null and empty texts are the end token alone and are not
    kept. Null languages are one language. Without trusted text everything with words is kept. Rows with equal or null ids are separate
    documents, each of its own language; rows with equal ids are all trusted or none, and the model learns from equal rows as often as they
    come. A text of any length is learned from and scored whole. Other columns are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    good = labels.groupBy(F.col(id_column).alias("good")).agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("trusted")).where("trusted")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(lang_column, F.lit("")).alias("lang"), F.col(text_column).alias("text"))
    good = materialize(good.where(F.col("good").isNotNull()), "trusted")
    trusted = F.coalesce("trusted", F.lit(False))
    learn = trusted & F.coalesce(F.length("text") > 0, F.lit(False)) & (F.pmod(F.xxhash64("text", "id"), F.lit(5)) != 0)
    joined = rows.join(small(good), F.col("id") == F.col("good"), "left")
    flagged = joined.select("id", "lang", "text", learn.alias("learn"), trusted.alias("trusted"), F.lit(True).alias("asked"))
    scored = _score(flagged, BLOCK_BYTES, _sharded(flagged, MODEL_BYTES, SHARD_BYTES))
    met = materialize(scored.withColumn("rate", -F.col("log10") / F.col("n_tokens")), "rates")
    reference = met.where((F.col("n_tokens") > 1) & F.col("trusted") & ~F.col("learn"))
    cut = F.percentile_approx("rate", QUANTILE, F.lit(10_000))
    bounds = reference.groupBy("lang").agg(cut.alias("bound"))
    overall = reference.agg(cut).first()[0]
    high = F.coalesce("bound", F.lit(overall).cast("double"), F.lit(float("inf"))) + MARGIN
    judged = met.join(small(bounds), "lang", "left").withColumn("high", high)
    kept = (F.col("n_tokens") > 1) & (F.col("rate") <= F.col("high"))
    return judged.select(
        F.col("id").alias(id_column), "lang", "n_tokens", "log10", F.pow(F.lit(10.0), "rate").alias("perplexity"),
        F.pow(F.lit(10.0), "high").alias("high"), kept.alias("kept"),
    )


def op7_quality(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
