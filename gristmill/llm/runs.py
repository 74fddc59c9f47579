"""Periodic runs of words, found with a dictionary of basic factors.

A basic factor is a stretch of 1, 2, 4, ... words; stretches of one length have equal names if they are equal. A run of period
q repeats its factors of length L <= q < 2L at distance q, so per length the successor occurrences of a factor within
2L propose periods. Where a factor's own period is over L/2 its next three occurrences are all there are within 2L. Where it
is L/2 or less, occurrences form arithmetic progressions, and the first one past the end of the progression proposes the
period: the run either repeats that progression, or has a factor across the progression's end, whose period is long. Every
proposal is extended both ways to the whole run; runs with the same borders are one, of the smallest period.

Only factors that occur twice in a document can be halves of longer ones that do, so few are left after some levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, prepare, table, words_of

LEAST = 12
#: Documents are handled together up to so many words; a longer one alone.
WORDS = 200_000
_FAR = 1 << 40
_STEPS = 16


def find_runs(words: np.ndarray, doc: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end, period) of all runs, by start and period. ``words`` are names of the words at consecutive places, ``doc`` numbers
    the document of each place in ascending order; a run lies in one document."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    word = np.unique(doc.astype(np.int64) * (int(words.max()) + 1) + words, return_inverse=True)[1]
    longest = int(np.bincount(doc).max())
    found, length = [], 1
    place, order, name = np.arange(len(word)), np.argsort(word, kind="stable"), word
    while 2 * length <= longest:
        place, name = _repeated(place[order], name[order])
        if not len(place):
            break
        found.append(_proposals(place, name, length))
        # Names at each place, to join each factor with the one behind it.
        at = np.full(len(word) + length, -1, np.int64)
        at[place] = name
        second = at[place + length]
        both = (second >= 0) & (doc[place] == doc[np.minimum(place + length, len(word) - 1)])
        place, key = place[both], name[both] * len(word) + second[both]
        by_place = np.argsort(place)
        place, key = place[by_place], key[by_place]
        order, name = np.argsort(key, kind="stable"), key
        length *= 2
    return _runs(word, found, least)


def _repeated(place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the factors that occur more than once; both come and go by key, then place."""
    if not len(key):
        return place, key
    first = np.concatenate(([True], key[1:] != key[:-1]))
    name = np.cumsum(first) - 1
    often = np.bincount(name)[name] > 1
    return place[often], name[often]


def _proposals(place: np.ndarray, name: np.ndarray, length: int) -> np.ndarray:
    """(distance, place, length of the matched factor): periods from ``length`` to below twice that."""
    n = len(place)
    gap = np.full(n, _FAR, np.int64)
    gap[:-1] = np.where(name[1:] == name[:-1], place[1:] - place[:-1], _FAR)
    near = np.flatnonzero(gap < 2 * length)
    out = []
    for step in (1, 2, 3):
        at = near[near + step < n]
        at = at[name[at + step] == name[at]]
        out.append((place[at + step] - place[at], place[at]))
    short = near[2 * gap[near] <= length]
    if len(short):
        # The progression of each occurrence goes on to the next place where the gap is another.
        change = np.append(np.flatnonzero(gap[1:] != gap[:-1]) + 1, n - 1)
        last = change[np.searchsorted(change, short, side="right")]
        on = gap[last] < _FAR
        out.append((place[last[on] + 1] - place[short[on]], place[short[on]]))
    distance, start = (np.concatenate([x[i] for x in out]) for i in (0, 1))
    fits = (distance >= length) & (distance < 2 * length)
    distance, start = distance[fits], start[fits]
    return np.stack([distance, start, np.full(len(start), length)], axis=1)


def _runs(word: np.ndarray, found: list[np.ndarray], least: int) -> np.ndarray:
    """The proposals extended to whole runs."""
    proposed = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    if not len(proposed):
        return proposed
    proposed = proposed[np.lexsort((proposed[:, 1], proposed[:, 0]))]
    distance, start, length = proposed.T
    # Matches of one distance that overlap or touch are one; all of one distance have one length.
    new = np.concatenate(([True], (distance[1:] != distance[:-1]) | (start[1:] > start[:-1] + length[:-1])))
    begin = np.flatnonzero(new)
    final = np.append(begin[1:], len(start)) - 1
    low, high, period = start[begin], start[final] + length[final], distance[begin]
    low, high = _extended(word, low, high, period)
    fits = high + period - low >= np.maximum(least, 2 * period)
    rows = np.stack([low[fits], (high + period)[fits], period[fits]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        rows = rows[np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _extended(word: np.ndarray, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``low`` to ``high`` of places whose word comes again a period later, as long as they get."""
    low, high = low.copy(), high.copy()
    down, up = np.arange(len(low)), np.arange(len(low))
    for _ in range(_STEPS):
        ok = low[down] > 0
        down = down[ok]
        down = down[word[low[down] - 1] == word[low[down] - 1 + period[down]]]
        low[down] -= 1
        ok = high[up] + period[up] < len(word)
        up = up[ok]
        up = up[word[high[up]] == word[high[up] + period[up]]]
        high[up] += 1
    # Long ones one after the other in growing chunks; one that an earlier one covers has its borders.
    covered: dict[int, int] = {}
    for at in np.union1d(down, up).tolist():
        p, before = int(period[at]), covered.get(int(period[at]))
        if before is not None and low[at] < high[before]:
            low[at], high[at] = low[before], high[before]
            continue
        low[at] = _walk(word, int(low[at]), p, -1)
        high[at] = _walk(word, int(high[at]), p, 1)
        covered[p] = at
    return low, high


def _walk(word: np.ndarray, border: int, period: int, step: int) -> int:
    """The border moved on while words are equal to those a period later."""
    chunk = 64
    while True:
        if step > 0:
            size = min(chunk, len(word) - period - border)
            equal = word[border : border + size] == word[border + period : border + period + size]
        else:
            size = min(chunk, border)
            equal = (word[border - size : border] == word[border - size + period : border + period])[::-1]
        if size <= 0:
            return border
        stop = int(np.argmin(equal))
        if not equal[stop]:
            return border + step * stop
        border += step * size
        chunk *= 2


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, of each run the first period only, joined by one blank."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist())


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST) -> DataFrame:
    """(``id_column``, n_words, runs, text): every run of each text, and the text with each run cut to its first period.

    Words are what stands between ASCII white space. A run is a stretch of words with smallest period q and length of at least
    ``least`` and 2q that no neighbouring word extends; runs have start (a word number), length and period, by start, then
    period. Kept words are joined by one blank. Null and empty texts have no words. Rows with equal or null ids are separate;
    a text of any length is searched whole. Other columns are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)

    def flush(held: list[tuple[int | None, list[bytes]]]) -> Iterator[dict]:
        numbers = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in held for w in words))}
        flat = np.fromiter((numbers[w] for _, words in held for w in words), np.int64)
        sizes = [len(words) for _, words in held]
        begin = np.concatenate(([0], np.cumsum(sizes)))
        runs = find_runs(flat, np.repeat(np.arange(len(held)), sizes), least)
        cuts = np.searchsorted(runs[:, 0], begin)
        for at, (key, words) in enumerate(held):
            own = runs[cuts[at] : cuts[at + 1]] - np.array([begin[at], begin[at], 0])
            listed = [{"start": s, "length": e - s, "period": q} for s, e, q in own.tolist()]
            yield {"id": key, "n_words": len(words), "runs": listed, "text": collapsed(words, own).decode()}

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        held, size = [], 0
        for row in rows:
            words = (row["text"] or "").encode().split()
            if held and size + len(words) > WORDS:
                yield from flush(held)
                held, size = [], 0
            held.append((row["id"], words))
            size += len(words)
        if held:
            yield from flush(held)

    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    schema = "id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string"
    return map_rows(narrow, run, schema).withColumnRenamed("id", id_column)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the hash of its id, repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words, n = F.col("words"), F.size("words")
    found = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    g = F.floor(F.col("h") / 10)
    found = found.withColumn("a", (g % F.when(n > 0, n)).cast("int"))
    rest = n - F.col("a")
    found = found.withColumn("p", (F.lit(1) + F.floor(rest / (F.lit(3) + g % 8))).cast("int"))
    period = F.slice(words, F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a")), tail), " ")
    return found.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    runs = F.col("runs")
    longest = F.reduce(runs, F.lit(0).cast("bigint"), lambda most, r: F.greatest(most, r["length"]))
    # Runs come by start, then period, so the first of the longest ones is the one asked for.
    best: Column = F.element_at(F.filter(runs, lambda r: r["length"] == longest), 1)
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    found = found.withColumn("best", F.when(F.size(runs) > 0, best))
    return found.select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )
