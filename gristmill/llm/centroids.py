"""Clustering around centroids over a vector-approximation file.

Vectors are whole numbers, kept in blocks. Beside its vectors a block has an approximation of each: per dimension one of 16
cells, whose borders are the least and largest component of the block's vectors in it. For a set of centroids a table
gives the least and largest squared difference of each cell from each centroid's component; their sums over a vector's
cells are an interval around its distance. Where one centroid's interval lies below all others the vector is decided without
being looked at; only where intervals overlap the full vector is fetched, for the centroids still possible.

Sums are kept from round to round: a vector that stays where it was is not fetched for them either. What it was is found again
from the approximation and the centroids before, so nothing is shuffled or rewritten between rounds; the blocks are
written once, to the shared folder. Sums are of whole numbers, so results do not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, materialize, prepare, table

DIM = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
CELLS = 16
#: Vectors of a block: about 1 MB in full and 128 KB approximated.
BLOCK = 4096
#: Scaled components are below 2^27, so a distance fits into 64 bits.
LARGEST = float(1 << 19)

Ints = list[list[int]]


def usable(vector: Column, dim: int = DIM) -> Column:
    """Whether a vector has ``dim`` components, each a number that can be scaled."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    return F.coalesce((F.size(vector) == dim) & fits, F.lit(False))


@dataclass
class Block:
    """A block's vectors, approximated: two cells a byte, and the borders of each dimension's cells."""

    ids: list[int | None]
    low: np.ndarray
    high: np.ndarray
    codes: np.ndarray
    full: bytes
    dim: int

    @classmethod
    def build(cls, ids: list, values: np.ndarray, cells: int = CELLS) -> "Block":
        n, dim = values.shape
        ranks = np.sort(values, axis=0)
        # Cells of about equally many vectors; equal components share a cell.
        uppers = ranks[np.arange(1, cells + 1) * n // cells - 1 if n >= cells else np.minimum(np.arange(cells), n - 1)]
        cell = np.stack([np.searchsorted(uppers[:, d], values[:, d]) for d in range(dim)], axis=1)
        low = np.full((dim, cells), np.iinfo(np.int64).max)
        high = np.full((dim, cells), np.iinfo(np.int64).min)
        for d in range(dim):
            np.minimum.at(low[d], cell[:, d], values[:, d])
            np.maximum.at(high[d], cell[:, d], values[:, d])
        empty = low > high
        low[empty] = high[empty] = 0
        if dim % 2:
            cell = np.concatenate([cell, np.zeros((n, 1), cell.dtype)], axis=1)
        codes = (cell[:, ::2] * cells + cell[:, 1::2]).astype(np.uint8)
        kind = np.int16 if n and np.abs(values).max() < 1 << 15 else np.int32
        return cls(ids, low, high, codes, values.astype(kind).tobytes(), dim)

    def row(self) -> dict:
        borders = np.stack([self.low, self.high]).astype(np.int32).tobytes()
        return {"ids": self.ids, "borders": borders, "codes": self.codes.tobytes(), "vectors": self.full}

    @classmethod
    def of(cls, row: dict, dim: int, cells: int = CELLS) -> "Block":
        low, high = np.frombuffer(row["borders"], np.int32).reshape(2, dim, cells).astype(np.int64)
        codes = np.frombuffer(row["codes"], np.uint8).reshape(len(row["ids"]), -1)
        return cls(row["ids"], low, high, codes, row["vectors"], dim)

    def fetch(self, which: np.ndarray) -> np.ndarray:
        """The full vectors at some places."""
        kind = np.int16 if len(self.full) == 2 * len(self.ids) * self.dim else np.int32
        return np.frombuffer(self.full, kind).reshape(-1, self.dim)[which].astype(np.int64)

    def intervals(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible squared distance of each vector from each centroid."""
        below = self.low[:, :, None] - centroids.T[:, None, :]
        above = centroids.T[:, None, :] - self.high[:, :, None]
        near = np.maximum(np.maximum(below, above), 0) ** 2
        far = np.maximum(np.abs(below), np.abs(above)) ** 2
        least, most = (self._summed(x) for x in (near, far))
        return least, most

    def _summed(self, cell_table: np.ndarray) -> np.ndarray:
        """Sums of a table (dimension, cell, centroid) over the cells of each vector, two dimensions at a time."""
        if self.dim % 2:
            cell_table = np.concatenate([cell_table, np.zeros_like(cell_table[:1])])
        pairs = cell_table[::2, :, None, :] + cell_table[1::2, None, :, :]
        pairs = pairs.reshape(len(pairs), -1, cell_table.shape[2])
        if int(pairs.max(axis=(1, 2)).sum()) < 1 << 31:
            pairs = pairs.astype(np.int32)
        total = np.zeros((len(self.ids), cell_table.shape[2]), pairs.dtype)
        for pair, code in zip(pairs, self.codes.T):
            total += pair[code]
        return total

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest centroid of each vector, the smaller number of equally near ones; places of the vectors fetched for it)."""
        least, most = self.intervals(centroids)
        possible = least <= most.min(axis=1, keepdims=True)
        nearest = possible.argmax(axis=1)
        open_ = np.flatnonzero(possible.sum(axis=1) > 1)
        if len(open_):
            at, k = np.nonzero(possible[open_])
            distance = np.full((len(open_), len(centroids)), np.iinfo(np.int64).max)
            vectors = self.fetch(open_)
            for some in range(0, len(at), 1 << 15):
                i, j = at[some : some + (1 << 15)], k[some : some + (1 << 15)]
                distance[i, j] = ((vectors[i] - centroids[j]) ** 2).sum(axis=1)
            nearest[open_] = distance.argmin(axis=1)
        return nearest, open_


def blocks_of(kept: DataFrame, dim: int, block: int) -> DataFrame:
    """Blocks of the usable vectors ``id, v``, scaled to whole numbers, written to the shared folder."""
    schema = "ids array<bigint>, borders binary, codes binary, vectors binary"
    arrow = pa.schema([("ids", pa.list_(pa.int64())), *[(n, pa.binary()) for n in ("borders", "codes", "vectors")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: list[np.ndarray] = []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            held.append(np.floor(flat * SCALE).astype(np.int64).reshape(-1, dim))
            while len(ids) >= block:
                values = np.concatenate(held)
                yield pa.RecordBatch.from_pylist([Block.build(ids[:block], values[:block]).row()], schema=arrow)
                ids, held = ids[block:], [values[block:]]
        if ids:
            yield pa.RecordBatch.from_pylist([Block.build(ids, np.concatenate(held)).row()], schema=arrow)

    return materialize(kept.select("id", "v").mapInArrow(run, schema), "vector-blocks")


def _first(kept: DataFrame, k: int, seed: int) -> Ints:
    """The scaled vectors of the smallest hashes; equal hashes, of rows with one id, go by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    scaled = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    rows = kept.select(key.alias("key"), scaled.alias("v")).orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return [list(r["v"]) for r in rows]


def _moved(blocks: DataFrame, dim: int, centroids: Ints, before: Ints | None) -> tuple[dict[tuple[int, int], int], dict[int, int]]:
    """Change of each cluster's component sums and size when the centroids change from ``before``."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        now = np.array(centroids, np.int64)
        old = None if before is None else np.array(before, np.int64)
        sums, sizes = np.zeros((len(now), dim), np.int64), np.zeros(len(now), np.int64)
        for row in rows:
            block = Block.of(row, dim)
            new = block.assign(now)[0]
            if old is None:
                was, which = None, np.arange(len(new))
            else:
                was = block.assign(old)[0]
                which = np.flatnonzero(was != new)
            vectors = block.fetch(which)
            np.add.at(sums, new[which], vectors)
            np.add.at(sizes, new[which], 1)
            if was is not None:
                np.subtract.at(sums, was[which], vectors)
                np.subtract.at(sizes, was[which], 1)
        for k in range(len(now)):
            if sizes[k] or sums[k].any():
                yield {"cluster": k, "parts": [int(sizes[k]), *sums[k].tolist()]}

    found = map_rows(blocks, run, "cluster int, parts array<bigint>").select("cluster", F.posexplode("parts").alias("at", "part"))
    rows = found.groupBy("cluster", "at").agg(F.sum("part").alias("part")).collect()
    sums = {(r["cluster"], r["at"] - 1): r["part"] for r in rows if r["at"]}
    return sums, {r["cluster"]: r["part"] for r in rows if not r["at"]}


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    dim: int = DIM, seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """(``id_column``, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector.

    Components are scaled by 256 and rounded down. Centroids start as the ``k`` vectors whose ids hash smallest; a round gives
    every vector to its nearest centroid, of equally near ones the smaller number, and moves each centroid that has vectors to
    the floor of their mean. Vectors that are null, of another length, or hold null or non-finite components, or components of
    2^19 or more, whose squared distances would not fit into 64 bits, are left out. Rows with equal or null ids are
    separate vectors; null ids start no centroid before others do. With fewer vectors than ``k`` there are fewer centroids.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = prepare(vectors.sparkSession)
    narrow = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v"))
    kept = narrow.where(usable(F.col("v"), dim))
    blocks = blocks_of(kept, dim, block)
    centroids = _first(kept, k, seed)
    before: Ints | None = None
    sums = [[0] * dim for _ in centroids]
    sizes = [0] * len(centroids)
    for _ in range(rounds if centroids else 0):
        change, resized = _moved(blocks, dim, centroids, before)
        for (c, d), part in change.items():
            sums[c][d] += part
        for c, part in resized.items():
            sizes[c] += part
        before = centroids
        centroids = [[s // n for s in row] if n else old for row, n, old in zip(sums, sizes, before)]

    def measure(rows: Iterator[dict]) -> Iterator[dict]:
        final = np.array(centroids, np.int64)
        for row in rows:
            part = Block.of(row, dim)
            nearest = part.assign(final)[0]
            distance = ((part.fetch(np.arange(len(nearest))) - final[nearest]) ** 2).sum(axis=1)
            for i, c, d in zip(part.ids, nearest.tolist(), distance.tolist()):
                yield {"id": i, "cluster": c, "distance": d}

    placed = materialize(map_rows(blocks, measure, "id bigint, cluster int, distance bigint"), "clustered")
    totals = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    about = [(c, totals[c], sum(totals.values()), centroids[c]) for c in sorted(totals)]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    # A row per cluster: at most k.
    joined = placed.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_hash(components: Column) -> Column:
    return F.sha2(F.array_join(components.cast("array<string>"), ","), 256)


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_hash(F.col("centroid")).alias("centroid_sha256"))


def _op12_sql() -> str:
    """Every round written out; DuckDB's ``//`` cuts toward zero, so the rest is taken off first."""
    floor = "((total - ((total % n) + n) % n) // n)"
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})""",
        f"""centroids_0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS INT) AS cluster, v
  FROM kept ORDER BY cluster LIMIT {CENTROIDS})""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""placed_{i} AS (SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min_by(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM (SELECT k.row, k.vec_id, k.v, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
        FROM kept k, centroids_{i} c) GROUP BY row)""")
        if i < ROUNDS:
            steps.append(f"""centroids_{i + 1} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroids_{i} c LEFT JOIN (
  SELECT cluster, list({floor} ORDER BY d) AS v FROM (
    SELECT cluster, d, sum(v[d]) AS total, count(*) AS n FROM placed_{i}, (SELECT unnest(range(1, {DIM + 1})) AS d) GROUP BY cluster, d)
  GROUP BY cluster) m USING (cluster))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(list_aggregate(c.v, 'string_agg', ',')) AS centroid_sha256
FROM placed_{ROUNDS} JOIN centroids_{ROUNDS} c USING (cluster)"""


OP12_SQL = _op12_sql()
