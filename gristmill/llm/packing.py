"""Packing token sequences of documents into as few fixed-length sequences as possible, by exact complements.

Only lengths matter for packing, and there are at most ``capacity`` of them, so the plan is made on their histogram: at
most 4,096 numbers, whatever the corpus. Available lengths and their pair sums are kept as bit sets; for each length, longest
first, a single, pair or triple that fills the gap exactly is taken as often as the counts allow. What has no exact
complement goes best-fit into the smallest gap that takes it. A pattern is stored once with how often it occurs, and
every use exhausts a length, so the plan has a few thousand rows. Pieces find their place by rank within their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, materialize, prepare, shards_for, table, worker_state

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers before it forgets those that its texts at hand do not hold; about 150 MB.
REMEMBERED = 600_000
PIECES_PER_PART = 1_000_000
OWNER = "packing"
_BETWEEN = "<|endoftext|>"
#: Marks that NFC composes with a small letter but not with its capital (the marks of ẗ, ẘ, ẙ, ǰ and ẖ, and U+0344, which starts with one).
_SMALL_ONLY = re.compile("[\u0308\u030a\u030c\u0331\u0344]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cased(text: str) -> bytes:
    data = text.encode()
    return data.lower() if text.isascii() or not _SMALL_ONLY.search(text) else data


class WordIds:
    """Ids of whole texts from remembered ids of their words.

    The vocabulary's splitting never joins characters across ASCII white space, nor a letter or digit with a full stop or
    comma behind it, and it lowers case itself, so the ids of a text are those of its words in order. It does so after NFC; words
    are remembered with A-Z in lower case, but in their own case in texts with a mark that composes with small letters only.
    Texts with "<|", which starts special tokens, are encoded as they are.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        # A task has one core; threads that wait for a share of its texts only take time from others.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._remembered = remembered
        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[bytes, bytes] = {}
        self._between = self._tokenizer.token_to_id(_BETWEEN)

    @classmethod
    def shared(cls, path: str, remembered: int = REMEMBERED) -> "WordIds":
        state = worker_state(OWNER)
        if getattr(state, "made_for", None) != (path, remembered):
            state.made_for, state.ids = (path, remembered), cls(path, remembered)
        return state.ids

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words many at a time, with the end-of-text token between them, which no word holds.

        The call for batches keeps no offsets, which are a quarter of the work.
        """
        known = self._known
        for at in range(0, len(words), 200):
            some = words[at : at + 200]
            joined = _BETWEEN.join([w.decode() for w in some]) + _BETWEEN
            data = np.array(self._tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            raw, start = data.tobytes(), 0
            for word, end in zip(some, np.flatnonzero(data == self._between).tolist()):
                known[word] = raw[4 * start : 4 * end]
                start = end + 1

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        known = self._known
        # Equal words are one object: as objects of their own they would be ten times their bytes.
        one: dict[bytes, bytes] = {}
        parts = [None if "<|" in t else [*map(one.setdefault, found := _cased(t).split(), found)] for t in texts]
        words = one.keys()
        missing = words - known.keys()
        if len(known) + len(missing) > self._remembered:
            # Words that come again are among these; most others came once.
            self._known = known = {w: known[w] for w in words - missing}
        # A word with a full stop or comma behind it is the word and that character.
        split = {w for w in missing if w[-1] in b".," and len(w) > 1 and w[-2:-1].isalnum()}
        bare = {w[:-1] for w in split} | {w[-1:] for w in split} | (missing - split)
        self._learn(list(bare.difference(known)))
        for w in split:
            known[w] = known[w[:-1]] + known[w[-1:]]
        special = iter(self._encoded([t for t, p in zip(texts, parts) if p is None]))
        return [next(special) if p is None else b"".join(map(known.__getitem__, p)) for p in parts]


def pieces(
    docs: DataFrame, id_column: str, text_column: str, path: str, capacity: int, keep_ids: bool, remembered: int = REMEMBERED
) -> DataFrame:
    """(id, piece, start, length, crc[, ids]): documents cut into pieces of at most ``capacity`` ids."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        encoder = WordIds.shared(path, remembered)
        for some in _batches(rows):
            for row, ids in zip(some, encoder.encode([r["text"] or "" for r in some])):
                ids += np.uint32(END_ID).tobytes()
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out = {"id": row["id"], "piece": piece, "start": at // 4, "length": len(part) // 4, "crc": zlib.crc32(part)}
                    yield out | {"ids": np.frombuffer(part, np.uint32).tolist()} if keep_ids else out

    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return map_rows(narrow, run, "id bigint, piece int, start bigint, length bigint, crc bigint" + ", ids array<bigint>" * keep_ids, OWNER)


def _batches(rows: Iterator[dict], size: int = 4 << 20) -> Iterator[list[dict]]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row["text"] or "")
        if chars >= size:
            yield held
            held, chars = [], 0
    if held:
        yield held


class _Lengths:
    """Counts of available lengths, with bit sets of the lengths and of the sums of two."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts, self.capacity = dict(counts), capacity
        self._refresh()

    def _refresh(self) -> None:
        self.one = sum(1 << x for x, n in self.counts.items() if n)
        two = 0
        for x, n in self.counts.items():
            if n:
                two |= (self.one & ~(1 << x) if n < 2 else self.one) << x
        self.two = two & ((1 << self.capacity + 1) - 1)
        self._one, self._two = self._reversed(self.one), self._reversed(self.two)

    def _reversed(self, bits: int) -> int:
        return int(format(bits, f"0{self.capacity + 1}b")[::-1], 2)

    def take(self, lengths: Counter, times: int) -> None:
        gone = False
        for x, n in lengths.items():
            self.counts[x] -= n * times
            gone |= self.counts[x] < 2
        if gone:
            self._refresh()

    def times(self, lengths: Counter) -> int:
        return min(self.counts.get(x, 0) // n for x, n in lengths.items())

    def complements(self, gap: int, most: int) -> Iterator[tuple[int, ...]]:
        """Up to ``most`` available lengths that add up to the gap, larger ones first."""
        if self.one >> gap & 1:
            yield (gap,)
        if most > 1:
            yield from self._pairs(gap, self.capacity)
        if most > 2:
            firsts = self.one & self._two >> self.capacity - gap
            while firsts:
                c = firsts.bit_length() - 1
                firsts ^= 1 << c
                yield from ((c, a, b) for a, b in self._pairs(gap - c, c))

    def _pairs(self, gap: int, highest: int) -> Iterator[tuple[int, int]]:
        found = self.one & self._one >> self.capacity - gap & ((1 << highest + 1) - 1)
        while found:
            a = found.bit_length() - 1
            if 2 * a < gap:
                return
            found ^= 1 << a
            yield a, gap - a


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, copies), ...]) of each pattern, for a histogram of lengths from 1 to ``capacity``."""
    out: list[tuple[int, list[tuple[int, int]]]] = []
    free = _Lengths({x: n for x, n in counts.items() if n}, capacity)
    for length in sorted(free.counts, reverse=True):
        while free.counts[length]:
            best = None
            for rest in [()] if length == capacity else free.complements(capacity - length, 3):
                pattern = Counter((length, *rest))
                if n := free.times(pattern):
                    best = n, pattern
                    break
            if best is None:
                break
            free.take(best[1], best[0])
            out.append((best[0], sorted(best[1].items(), reverse=True)))
    return out + _best_fit({x: n for x, n in free.counts.items() if n}, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Longest first, into the smallest gap that takes it; equal sequences are handled together."""
    open_: dict[int, list[tuple[int, tuple]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and (gap := min((g for g in open_ if g >= length), default=None)) is not None:
            times, content = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            copies = min(gap // length, max(1, left // times))
            used = min(times, left // copies)
            if used < times:
                open_.setdefault(gap, []).append((times - used, content))
            open_.setdefault(gap - copies * length, []).append((used, (*content, (length, copies))))
            left -= used * copies
        each = capacity // length
        for copies, times in ((each, left // each), (left % each, 1)):
            if copies and times:
                open_.setdefault(capacity - copies * length, []).append((times, ((length, copies),)))
    return [(times, list(content)) for gap in sorted(open_) for times, content in open_[gap]]


def _intervals(patterns: list[tuple[int, list[tuple[int, int]]]]) -> tuple[np.ndarray, ...]:
    """By length and first rank: copies per sequence, first sequence, offset of the first copy."""
    rows, rank, sequence = [], Counter(), 0
    for times, content in patterns:
        offset = 0
        for length, copies in content:
            rows.append((length << 40 | rank[length], copies, sequence, offset))
            rank[length] += times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(4))


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, capacity: int = CAPACITY,
    keep_ids: bool = False, remembered: int = REMEMBERED,
) -> DataFrame:
    """(``id_column``, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece.

    Ids are the tokenizer's, then one end id. Longer documents are cut into pieces of ``capacity``; nothing else is cut.
    Null and empty texts are the end id alone. Rows with equal or null ids are separate documents. Other columns are
    ignored; an empty table gives an empty result. ``remembered`` words' ids are kept by a worker: more memory, less work.
    """
    prepare(docs.sparkSession)
    cut = materialize(pieces(docs, id_column, text_column, path or tokenizer_path(), capacity, keep_ids, remembered), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    firsts, copies, sequences, offsets = _intervals(plan(counts, capacity))
    parts = shards_for(sum(counts.values()), PIECES_PER_PART, 8)
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("length", "part").orderBy("id", "piece", "crc")
    ranked = dealt.withColumn("row", F.row_number().over(within) - 1).join(bases.drop("n"), ["length", "part"])

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = length.to_numpy() << 40 | rank.to_numpy()
        at = np.searchsorted(firsts, key, side="right") - 1
        local = key - firsts[at]
        each = copies[at]
        return pd.DataFrame({"sequence_id": sequences[at] + local // each, "offset": offsets[at] + local % each * length.to_numpy()})

    placed = ranked.withColumn("at", place(F.col("length"), (F.col("base") + F.col("row")).cast("bigint")))
    return placed.select(
        F.col("id").alias(id_column), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "at.sequence_id", "at.offset",
        *["ids"] * keep_ids,
    )


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
