"""Documents in blocks: one row holds the normalised words of many documents, compressed.

Operators that need a corpus-wide count for each of a document's many pieces ask for it block by block: a block sends
each distinct piece once to the shard that owns it, in sorted and compressed arrays, and the shard answers in the same
order. That moves a few bytes per distinct piece instead of a row per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import expand, map_rows, materialize, squeeze

BLOCK_BYTES = 16 << 20
SCHEMA = "block bigint, ids array<bigint>, learn array<boolean>, ends array<bigint>, n_words bigint, n_bytes bigint, text binary"


def cut(docs: DataFrame, id_column: str, text_column: str, lower: bool, learn: Column | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of consecutive documents of a partition, written to the shared folder.

    Words are joined by one blank; ``ends`` has the end of each document in the concatenated text. A document longer
    than a block is a block of its own. Raise ``block_bytes`` with the executors' memory: what is asked for is distinct
    per block, so larger blocks ask less.
    """
    narrow = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(text_column).alias("text"),
        (F.lit(True) if learn is None else F.coalesce(learn, F.lit(True))).alias("learn"),
    )

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        partition, number = TaskContext.get().partitionId(), 0
        ids, learns, texts, size, words = [], [], [], 0, 0
        for row in rows:
            raw = (row["text"] or "").encode()
            found = (raw.lower() if lower else raw).split()
            if ids and size + len(raw) > block_bytes:
                yield _block(partition << 24 | number, ids, learns, texts, words)
                number += 1
                ids, learns, texts, size, words = [], [], [], 0, 0
            ids.append(row["id"])
            learns.append(row["learn"])
            texts.append(b" ".join(found))
            size += len(raw)
            words += len(found)
        if ids:
            yield _block(partition << 24 | number, ids, learns, texts, words)

    return materialize(map_rows(narrow, run, SCHEMA), "blocks")


def place(cut: DataFrame) -> Column:
    """Numbers of the blocks with few gaps: the first blocks of all partitions, then the second ones, and so on."""
    partitions = (cut.agg(F.max(F.shiftright("block", 24))).first()[0] or 0) + 1
    return F.col("block").bitwiseAND(F.lit((1 << 24) - 1)) * partitions + F.shiftright("block", 24)


def _block(block: int, ids: list, learns: list, texts: list[bytes], words: int) -> dict:
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64).tolist()
    text = b"".join(texts)
    return {"block": block, "ids": ids, "learn": learns, "ends": ends, "n_words": words, "n_bytes": len(text), "text": squeeze(text)}


def texts_of(row: dict) -> list[bytes]:
    """The documents of a block."""
    text, start, out = expand(row["text"]), 0, []
    for end in row["ends"]:
        out.append(text[start:end])
        start = end
    return out


def chunks(texts: list[bytes], size: int) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive documents of about ``size`` bytes each, with the number of the first."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, texts[first:at]
            first, held = at, 0
        held += len(text)
    if first < len(texts):
        yield first, texts[first:]
