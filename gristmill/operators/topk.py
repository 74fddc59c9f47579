"""Exact cosine top-k of stored vectors for a set of query vectors.

:func:`cosine_topk` is for queries the caller holds; :func:`cosine_topk_join` takes them as a frame of any size and
leaves out what cannot be among the nearest.

For held queries the vectors are scanned once per group of queries. Every task scores its batches with one matrix product and
keeps k candidates per query, so neither the pairs nor the vectors are shuffled; a final ranking merges the
tasks' candidates. The queries travel with the task, hence their byte size is bounded per scan; a larger set is
split into several scans.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.session import materialize

QUERY_BYTES_PER_SCAN = 16 * 1024 * 1024
#: Scores that are held at once.
SCORE_BYTES = 32 * 1024 * 1024
PIVOTS = 256
#: Room for rounding in bounds on scores; angles near zero are good to eight digits.
_ROOM = 1e-6
#: What two products of the same vectors may differ by after rounding.
_TIE = 2e-12


def cosine_topk(
    vectors: DataFrame,
    queries: Mapping[str, Sequence[float]],
    k: int,
    id_column: str = "review_id",
    vector_column: str = "embedding",
    query_bytes: int = QUERY_BYTES_PER_SCAN,
) -> DataFrame:
    """The k nearest ids of each query: ``query, rank, <id>, score``.

    Ranking uses twelve digits of the scores, beyond which only the order of summation shows; equal ones go to the
    smaller id. Null vectors are skipped, a vector of another length
    than the queries is an error. Apply filters on the metadata
    columns to ``vectors`` beforehand; they reach the scan.
    """
    if not queries:
        raise ValueError("no query vectors")
    dim = len(next(iter(queries.values())))
    if any(len(v) != dim for v in queries.values()):
        raise ValueError("query vectors differ in dimension")
    names = sorted(queries)
    per_scan = max(1, query_bytes // (8 * dim))
    groups = [names[i : i + per_scan] for i in range(0, len(names), per_scan)]
    fits = F.when(F.size(vector_column) == dim, F.col(vector_column)).otherwise(
        F.raise_error(F.concat(F.lit(f"vector of another length than {dim}: "), F.col(id_column).cast("string")))
    )
    usable = vectors.where(F.col(vector_column).isNotNull()).select(id_column, fits.alias(vector_column))
    id_type = usable.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("query", T.StringType()),
            T.StructField(id_column, id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    scans = [
        usable.mapInArrow(_scorer(group, np.array([queries[n] for n in group], dtype=np.float64), k), schema)
        for group in groups
    ]
    candidates = reduce(DataFrame.unionByName, scans)
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc(id_column))
    ranked = candidates.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", id_column, "score")


def cosine_topk_join(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    query_column: str = "query",
    query_vector: str = "vector",
    id_column: str = "review_id",
    vector_column: str = "embedding",
    block_rows: int = 16384,
    block_queries: int = 16384,
    pivots: int = PIVOTS,
    cell_rows: int = 1024,
) -> DataFrame:
    """The k nearest ids of each row of a query frame: ``query, rank, <id>, score``, ranked as :func:`cosine_topk` does.

    Keys on both sides must be unique. Every vector belongs to the cell of its nearest pivot, a stored vector itself; a
    cell's radius is the largest angle to it. Cells are packed into blocks, large ones cut, and queries into groups by their own
    cells. A query searches the block of its own nearest pivot first. Its k-th score then rules out every cell whose
    best possible score, by the triangle inequality of angles, is below that; only blocks with others are searched.
    Each block and group that meet are one matrix product in one task, taken in slices, so memory is bounded on both axes and a
    lost task gives the same blocks again. A vector is moved once per group or block it meets and keeps its own precision, and only
    what reaches the k-th score comes back. Null vectors on either side are skipped, lengths that differ are an error.
    """
    stored = vectors.where(F.col(vector_column).isNotNull()).select(F.col(id_column).alias("id"), _narrow(vectors, vector_column).alias("v"))
    asked = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_column).alias("query"), _narrow(queries, query_vector).alias("v"))
    # Up to ``pivots`` cells, of ``cell_rows`` vectors on average or more: smaller products do not pay.
    cells = _cells(stored, min(pivots, _blocks(stored.count(), cell_rows)), block_rows)
    asked = materialize(_assigned(asked, "query", cells.pivots), "topk-queries")
    per_cell = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    group = _place("query", *_packed([per_cell.get(c, 0) for c in range(len(cells.parts))], block_queries))
    asked = asked.select("query", "v", "cell", group.alias("group"))
    unbounded = F.lit(None).cast("double").alias("kth")
    asked_first = asked.where(_of_cell(cells.parts) > 0).select("query", "v", "group", unbounded, _blocks_of(F.col("cell"), cells).alias("blocks"))
    first = materialize(_search(cells, asked_first, k), "topk-first")
    reached = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    kth = asked.join(reached, "query", "left").withColumn("kth", F.when(F.col("n") >= k, F.col("least")))
    rest = _search(cells, materialize(_other_blocks(_with_cells(kth, cells), cells), "topk-rest"), k)
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("id"))
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", F.col("id").alias(id_column), "score")


def _narrow(df: DataFrame, column: str) -> Column:
    """Floats stay floats until they are multiplied; anything else is taken as doubles."""
    kind = df.schema[column].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(column) if floats else F.col(column).cast("array<double>")


def _packed(counts: list[int], most: int) -> tuple[list[int], list[int]]:
    """The first block of each cell and the number of its blocks: small cells share one, large ones have several."""
    first, parts, block, room = [], [], -1, 0
    for n in counts:
        if n > room:
            block, room = block + 1, most
        first.append(max(block, 0))
        parts.append(_blocks(n, most) if n else 0)
        room -= n
        if n > most:
            block, room = block + parts[-1] - 1, 0
    return first, parts


def _of_cell(numbers: list[int], cell: Column | None = None) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in numbers]), (F.col("cell") if cell is None else cell) + 1)


def _blocks_of(cell: Column, cells: _Cells) -> Column:
    """The blocks of a cell that holds vectors."""
    first = _of_cell(cells.first, cell)
    return F.sequence(first, first + _of_cell(cells.parts, cell) - 1)


def _place(key: str, first: list[int], parts: list[int]) -> Column:
    return _of_cell(first) + F.pmod(F.xxhash64(key), F.greatest(_of_cell(parts), F.lit(1))).cast("int")


@dataclass
class _Cells:
    """Assigned vectors, and what is known of each cell: bounded by the number of pivots."""

    stored: DataFrame
    pivots: np.ndarray
    radius: np.ndarray
    first: list[int]
    parts: list[int]


def _cells(stored: DataFrame, pivots: int, block_rows: int) -> _Cells:
    nonzero = stored.where(F.exists("v", lambda x: x != 0))
    chosen = nonzero.select("v", F.xxhash64("id").alias("h")).orderBy("h", "v").limit(pivots).collect()
    if len({len(r["v"]) for r in chosen}) > 1:
        raise ValueError("vectors of different lengths")
    matrix = _unit(np.array([r["v"] for r in chosen], np.float64)) if chosen else np.zeros((0, 0))
    assigned = materialize(_assigned(stored, "id", matrix), "topk-cells")
    about = {r["cell"]: r for r in assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()}
    number = max(1, len(matrix))
    radius = np.array([about[c]["radius"] if c in about else -np.inf for c in range(number)])
    first, parts = _packed([about[c]["n"] if c in about else 0 for c in range(number)], block_rows)
    return _Cells(assigned, matrix, radius, first, parts)


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(lengths == 0, 1.0, lengths)[:, None]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """A column of vectors as unit rows; other lengths are an error."""
    vectors = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.unique(np.diff(vectors.offsets.to_numpy()))
    if len(sizes) > 1 or dim is not None and len(sizes) and sizes[0] != dim:
        raise ValueError(f"vectors of different lengths: {sorted({*sizes.tolist(), *([dim] if dim else [])})}")
    return _unit(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1))


def _assigned(df: DataFrame, key: str, pivots: np.ndarray) -> DataFrame:
    """``key, v, cell, angle``: the nearest pivot and the angle to it. Zero vectors have a right angle with everything."""
    schema = T.StructType([*df.select(key, "v").schema, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, SCORE_BYTES // (8 * max(1, len(pivots))))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                if not len(pivots):
                    cell, angle = np.zeros(some.num_rows, np.int32), np.full(some.num_rows, np.pi)
                else:
                    angles = np.arccos(np.clip(_matrix(some.column(1), pivots.shape[1]) @ pivots.T, -1, 1))
                    cell = angles.argmin(axis=1).astype(np.int32)
                    angle = angles[np.arange(len(cell)), cell]
                columns = [some.column(0), some.column(1), pa.array(cell), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "v", "cell", "angle"])

    return df.select(key, "v").mapInArrow(run, schema)


def _with_cells(kth: DataFrame, cells: _Cells) -> DataFrame:
    """The queries with the cells, other than their first, that may hold one of their k nearest."""
    pivots, radius = cells.pivots, cells.radius
    columns = kth.select("query", "v", "cell", "group", F.col("kth").cast("double"))
    schema = T.StructType([*columns.schema, T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            if batch.num_rows and len(pivots):
                angles = np.arccos(np.clip(_matrix(batch.column(1)) @ pivots.T, -1, 1))
                bound = np.where(np.isneginf(radius), -np.inf, np.cos(np.maximum(0, angles - radius)))
                own = batch.column(2).to_numpy()
                least = batch.column(4).to_numpy(zero_copy_only=False)
                # A k-th score that is not known rules out nothing.
                possible = (bound >= np.where(np.isnan(least), -2, least)[:, None] - _ROOM) & ~np.isneginf(bound)
                possible[np.arange(len(own)), own] = False
                found = [np.flatnonzero(row).tolist() for row in possible]
            lists = pa.array(found or [[]] * batch.num_rows, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.names)

    return columns.mapInArrow(run, schema)


def _other_blocks(wanted: DataFrame, cells: _Cells) -> DataFrame:
    """The blocks of the queries' cells that they have not searched with their first."""
    some = wanted.where(F.size("cells") > 0)
    blocks = F.array_distinct(F.flatten(F.transform("cells", lambda c: _blocks_of(c, cells))))
    own = F.when(_of_cell(cells.parts) > 0, _blocks_of(F.col("cell"), cells)).otherwise(F.array().cast("array<int>"))
    return some.select("query", "v", "group", "kth", F.array_except(blocks, own).alias("blocks"))


def _search(cells: _Cells, asked: DataFrame, k: int) -> DataFrame:
    """``query, id, score``: up to k candidates of each query from every one of its ``blocks``."""
    right = asked.select("query", "v", "kth", "group", F.explode("blocks").alias("block"))
    # Renamed, since both sides of the grouping below come from the queries.
    pairs = right.select(F.col("block").alias("met"), F.col("group").alias("by")).distinct()
    left = cells.stored.select("id", "v", _place("id", cells.first, cells.parts).alias("block")).join(pairs, F.col("block") == F.col("met"))
    left = left.select("id", "v", "block", F.col("by").alias("group"))
    keys = ["block", "group"]
    kinds = right.schema["query"].dataType, left.schema["id"].dataType
    schema = T.StructType([T.StructField("query", kinds[0]), T.StructField("id", kinds[1]), T.StructField("score", T.DoubleType())])
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block_scorer(k), schema)


def _blocks(rows: int, per_block: int) -> int:
    return max(1, -(-rows // per_block))


def _block_scorer(k: int):
    def score(stored: pa.Table, asked: pa.Table) -> pa.Table:
        ids, names = stored.column("id"), asked.column("query")
        kinds = pa.schema([("query", names.type), ("id", ids.type), ("score", pa.float64())])
        if not stored.num_rows or not asked.num_rows:
            return kinds.empty_table()
        vectors, queries = _matrix(stored.column("v")), _matrix(asked.column("v"))
        if vectors.shape[1] != queries.shape[1]:
            raise ValueError(f"queries of length {queries.shape[1]}, vectors of length {vectors.shape[1]}")
        # Columns in the order of the ids: the first of equal scores is then the smallest id.
        order = np.array(pc.array_sort_indices(ids))
        vectors, kth = vectors[order], asked.column("kth").to_numpy()
        floor = np.where(np.isnan(kth), -np.inf, kth - _TIE)
        step, found = max(1, SCORE_BYTES // (8 * len(vectors))), []
        for at in range(0, len(queries), step):
            scores = np.rint((queries[at : at + step] @ vectors.T) * 1e12) / 1e12
            least = floor[at : at + step]
            if len(vectors) > k:
                least = np.maximum(least, np.partition(scores, len(vectors) - k, axis=1)[:, len(vectors) - k])
            rows, columns = np.nonzero(scores >= least[:, None])
            values = scores[rows, columns]
            best = np.lexsort((columns, -values, rows))
            rows, columns, values = rows[best], columns[best], values[best]
            # Of equal scores at the end there may be more than k.
            kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
            found.append((rows[kept] + at, order[columns[kept]], values[kept]))
        rows, columns, values = (np.concatenate([f[i] for f in found]) for i in range(3))
        return pa.table([names.take(pa.array(rows)), ids.take(pa.array(columns)), pa.array(values)], schema=kinds)

    return score


def _scorer(names: Sequence[str], matrix: np.ndarray, k: int):
    norms = np.linalg.norm(matrix, axis=1)
    unit = matrix / np.where(norms == 0, 1.0, norms)[:, None]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, dtype=object)) for _ in names]
        floor, id_type = np.full(len(names), -np.inf), None
        step = max(1, SCORE_BYTES // (8 * len(names)))
        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                scores = np.rint(_matrix(some.column(1)) @ unit.T * 1e12) / 1e12
                ids = np.array(some.column(0).to_pylist(), dtype=object)
                # Only what reaches a query's k-th score so far can change its k best.
                hits = scores >= floor
                for q in np.flatnonzero(hits.any(axis=0)).tolist():
                    found = hits[:, q]
                    best[q] = _best(np.concatenate([best[q][0], scores[found, q]]), np.concatenate([best[q][1], ids[found]]), k)
                    if len(best[q][0]) == k:
                        floor[q] = best[q][0][-1]
        if id_type is None:
            return
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name for name, (s, _) in zip(names, best) for _ in s], pa.string()),
                pa.array([i for _, found in best for i in found], id_type),
                pa.array(np.concatenate([s for s, _ in best]), pa.float64()),
            ],
            names=["query", "id", "score"],
        )

    return scan


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, ties by id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= floor
        scores, ids = scores[keep], ids[keep]
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k]
    return scores[order], ids[order]
