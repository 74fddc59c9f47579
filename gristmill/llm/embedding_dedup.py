"""Near-duplicate vectors by quantised tile products with error bounds.

Vectors of a label are dealt into tiles by hash. Tiles travel as int8 codes with a scale and an error per vector. Every pair of
tiles is one small group: the product of the codes (exact, as sums of whole numbers in floating point) approximates all
cosines, a bound from each vector's own quantisation error says how far each can be off, and the group names the vectors
with a partner that may reach the threshold. Only those are fetched in full, once for each pair of tiles that named them, and
recomputed in double precision. A group reports link counts per vector and edges that span its links, never all pairs. Equal
vectors are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import hash128, map_groups, map_rows, materialize, prepare, shards_for, table
from gristmill.llm.components import components

THRESHOLD = 0.98
TILE = 1024
_EXACT = 1024  # so many products of two codes of at most 127 add up exactly in float32
_PAIRS = 1 << 14
_ROWS = 128  # rows of a product that are compared at a time, so that they stay in the processor's cache
_TILES_PER_TASK = 16


class Codes:
    """Unit vectors as int8 codes: unit = scale * code + error, with a bound of the length of the error per vector."""

    def __init__(self, codes: np.ndarray, scale: np.ndarray, error: np.ndarray):
        self.codes, self.scale, self.error = codes, scale.astype(np.float64), error.astype(np.float64)

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        """Codes of vectors; scale and error are single precision numbers, the error rounded up."""
        unit = _unit(vectors)
        scale = (np.abs(unit).max(axis=1) / 127).astype(np.float32)
        codes = np.clip(np.rint(unit / scale[:, None].astype(np.float64)), -127, 127).astype(np.int8)
        error = np.linalg.norm(unit - scale[:, None].astype(np.float64) * codes, axis=1)
        return cls(codes, scale, np.nextafter(error.astype(np.float32), np.float32(np.inf)))

    @classmethod
    def read(cls, row: dict) -> Codes:
        codes = np.frombuffer(row["codes"], np.int8).reshape(-1, row["dim"])
        return cls(codes, np.frombuffer(row["scale"], np.float32), np.frombuffer(row["error"], np.float32))

    def written(self) -> dict:
        scale, error = self.scale.astype(np.float32), self.error.astype(np.float32)
        return {"codes": self.codes.tobytes(), "scale": scale.tobytes(), "error": error.tobytes()}


def _unit(vectors: np.ndarray) -> np.ndarray:
    exact = vectors.astype(np.float64)
    return exact / np.sqrt(np.einsum("ij,ij->i", exact, exact))[:, None]


def candidates(a: Codes, b: Codes, threshold: float) -> np.ndarray:
    """Pairs whose cosine may reach the threshold. With u = û + e: |u·v - û·v̂| <= (1+|e|)|f| + |e|(1+|f|) + |e||f|."""
    near = np.empty((len(a.codes), len(b.codes)), bool)
    other = b.codes.astype(np.float32).T
    for first in range(0, len(near), _ROWS):
        rows = slice(first, first + _ROWS)
        mine = a.codes[rows].astype(np.float32)
        product = np.zeros((len(mine), len(b.codes)))
        for at in range(0, mine.shape[1], _EXACT):
            product += mine[:, at : at + _EXACT] @ other[at : at + _EXACT]
        product *= a.scale[rows, None]
        product *= b.scale
        e, f = a.error[rows, None], b.error
        product += e * (1 + 3 * f)
        product += f
        np.greater_equal(product, threshold - 1e-12, out=near[rows])
    return near


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of vectors whose cosine in double precision reaches the threshold; the codes say which have to be computed."""
    rows, columns = np.nonzero(candidates(Codes.of(a), Codes.of(b), threshold))
    a, b = a.astype(np.float64), b.astype(np.float64)
    a_norm, b_norm = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (a, b))
    keep = []
    for at in range(0, len(rows), _PAIRS):
        i, j = rows[at : at + _PAIRS], columns[at : at + _PAIRS]
        keep.append(np.einsum("ij,ij->i", a[i], b[j]) / (a_norm[i] * b_norm[j]) >= threshold)
    kept = np.concatenate(keep) if keep else np.zeros(0, bool)
    return rows[kept], columns[kept]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    threshold: float = THRESHOLD, tile: int = TILE,
) -> DataFrame:
    """A row per vector: ``id_column``, n_links, component_id, kept.

    Vectors of one label and one length are linked when their cosine reaches ``threshold``. Vectors that are null, empty, zero
    or hold null or non-finite components, and those without a label, link with nothing. Rows with equal ids are
    separate vectors. Other columns are ignored; an empty table gives an empty result.
    """
    spark = prepare(vectors.sparkSession)
    h1, h2 = hash128(F.col("v"), "vector")
    narrow = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v"), F.col(label_column).alias("label"))
    marked = narrow.withColumn("ok", _usable(F.col("v")) & F.col("label").isNotNull())
    members = marked.select("id", "ok", "label", F.when(F.col("ok"), h1).alias("h1"), F.when(F.col("ok"), h2).alias("h2"))
    classes = marked.where("ok").groupBy("label", h1.alias("h1"), h2.alias("h2")).agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")
    )
    # A class is known by its hash, so ids may repeat or be null.
    classes = materialize(classes.withColumn("node", F.xxhash64("label", "h1", "h2")).withColumn("dim", F.size("v")), "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("tile", F.pmod("h1", "tiles").cast("int"))
    g1, g2 = F.xxhash64("label", "dim"), F.xxhash64(F.lit("group"), "label", "dim")
    dealt = dealt.withColumn("home", F.struct(g1.alias("g1"), g2.alias("g2"), "tile"))
    tiles = dealt.groupBy("home", "dim", "tiles").agg(F.collect_list(F.struct("node", "copies", "v")).alias("members"))
    single = vectors.schema[vector_column].dataType.elementType.typeName() == "float"
    number = np.dtype(np.float32 if single else np.float64)

    def packed(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            m = row.pop("members")
            data = np.array([x["v"] for x in m], number)
            nodes, copies = (np.array([x[k] for x in m], np.int64).tobytes() for k in ("node", "copies"))
            yield row | Codes.of(data).written() | {"nodes": nodes, "copies": copies, "vectors": data.tobytes()}

    home = "home struct<g1:bigint, g2:bigint, tile:int>"
    shape = f"{home}, dim int, tiles int, codes binary, scale binary, error binary, nodes binary, copies binary, vectors binary"
    blocks = materialize(map_rows(tiles, packed, shape), "vector-tiles")
    coded = blocks.select("home", "dim", "tiles", "codes", "scale", "error", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    low, high = F.least("home.tile", "other"), F.greatest("home.tile", "other")
    coded = coded.withColumn("pair", F.struct("home.g1", "home.g2", low.alias("low"), high.alias("high"))).drop("tiles", "other")
    compared, held_tiles = blocks.agg(F.coalesce(F.sum("tiles"), F.lit(0)), F.count(F.lit(1))).first()
    # Pairs stream through a task one by one, so any number of tasks will do.
    tasks = min(100_000, shards_for(compared, _TILES_PER_TASK, 8))

    def name(pair: dict, rows: Iterator[dict]) -> Iterator[dict]:
        yield from _wanted(pair, list(rows), threshold)

    def fetch(home: dict, rows: Iterator[dict]) -> Iterator[dict]:
        yield from _fetched(rows, number)

    def compare(pair: dict, rows: Iterator[dict]) -> Iterator[dict]:
        yield from _links(list(rows), number, threshold)

    pair = "pair struct<g1:bigint, g2:bigint, low:int, high:int>"
    named = map_groups(coded, "pair", tasks, name, f"{home}, {pair}, wanted binary")
    held = blocks.select("home", F.lit(0).alias("turn"), "dim", "nodes", "copies", "vectors")
    meeting = held.unionByName(named.withColumn("turn", F.lit(1)), allowMissingColumns=True)
    parts = min(100_000, shards_for(held_tiles, _TILES_PER_TASK, 8))
    full = map_groups(meeting, "home", parts, fetch, f"{pair}, tile int, dim int, nodes binary, copies binary, vectors binary", ("turn",))
    found = materialize(map_groups(full, "pair", tasks, compare, "node bigint, links bigint, other bigint"), "vector-links")
    counts = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("label", "h1", "h2", "node", "least", "copies").join(counts, "node", "left").join(grouped, "node", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "node")), "vector-components")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component_id")
    met = members.join(named, ["label", "h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    del spark
    return met.select(
        F.col("id").alias(id_column), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _wanted(pair: dict, rows: list[dict], threshold: float) -> Iterator[dict]:
    """The places in each tile of a pair that hold a vector with a possible partner in the other tile."""
    rows.sort(key=lambda r: r["home"]["tile"])
    near = candidates(Codes.read(rows[0]), Codes.read(rows[-1]), threshold)
    if len(rows) == 1:
        np.fill_diagonal(near, False)
    for row, axis in zip(rows, (1, 0)):
        places = np.flatnonzero(near.any(axis=axis))
        if len(places):
            yield {"home": row["home"], "pair": pair, "wanted": places.astype(np.int32).tobytes()}


def _fetched(rows: Iterator[dict], number: np.dtype) -> Iterator[dict]:
    """The named vectors of a tile for each of its pairs; the tile itself is the first row."""
    for row in rows:
        if row["turn"] == 0:
            tile, nodes, copies = row, np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["copies"], np.int64)
            vectors = np.frombuffer(row["vectors"], number).reshape(-1, row["dim"])
            continue
        at = np.frombuffer(row["wanted"], np.int32)
        some = {"nodes": nodes[at].tobytes(), "copies": copies[at].tobytes(), "vectors": vectors[at].tobytes()}
        yield some | {"pair": row["pair"], "tile": tile["home"]["tile"], "dim": tile["dim"]}


def _links(rows: list[dict], number: np.dtype, threshold: float) -> Iterator[dict]:
    """Link counts of the vectors fetched for a pair of tiles, and edges that span the links."""
    rows.sort(key=lambda r: r["tile"])
    read = [[np.frombuffer(r[k], np.int64) for k in ("nodes", "copies")] + [np.frombuffer(r["vectors"], number).reshape(-1, r["dim"])] for r in rows]
    (a_node, a_copies, a), (b_node, b_copies, b) = read[0], read[-1]
    i, j = linked(a, b, threshold)
    if len(rows) == 1:
        i, j = i[i != j], j[i != j]
        sides = [(i, a_node, b_copies[j])]
    else:
        sides = [(i, a_node, b_copies[j]), (j, b_node, a_copies[i])]
    for at, nodes, weight in sides:
        total = np.bincount(at, weights=weight, minlength=len(nodes))
        for k in np.flatnonzero(total).tolist():
            yield {"node": int(nodes[k]), "links": int(total[k])}
    if len(i):
        first = np.concatenate(([True], i[1:] != i[:-1]))
        chain = np.unique(j[1:][~first[1:]] * len(b_node) + j[:-1][~first[1:]])
        for x, y in zip(a_node[i[first]].tolist(), b_node[j[first]].tolist()):
            yield {"node": x, "other": y}
        for x, y in zip(b_node[chain // len(b_node)].tolist(), b_node[chain % len(b_node)].tolist()):
            yield {"node": x, "other": y}


def op3_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
