"""Connected components of a graph given as edges, distributed."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, materialize

ROUNDS = 50


class Forest:
    """Union-find over integers; the root of a set is its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent, start = self.parent, x
        while (up := parent.get(x, x)) != x:
            x = up
        while (up := parent.get(start, start)) != x:
            parent[start] = x
            start = up
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.parent.setdefault(min(a, b), min(a, b))


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b), b the smaller, with the same components, reduced within each partition.

    A partition works in pieces of a million edges, so its memory is bounded whatever the partition holds.
    """

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        forest, held = Forest(), 0
        for row in rows:
            forest.join(row["a"], row["b"])
            held += 1
            if held == 1_000_000:
                yield from _stars(forest)
                forest, held = Forest(), 0
        yield from _stars(forest)

    return map_rows(edges.select("a", "b"), run, "a bigint, b bigint")


def _stars(forest: Forest) -> Iterator[dict]:
    for x in list(forest.parent):
        if (top := forest.root(x)) != x:
            yield {"a": x, "b": top}


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b); the component is the smallest node reachable.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to its smallest neighbour, then
    its smaller ones. Each round is written to the shared folder. Rounds grow with the logarithm of the longest chain.
    """
    edges = materialize(contracted(edges.where("a <> b")).distinct(), "edges")
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = materialize(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        same = _digest(edges) == _digest(after)
        edges = after
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 20))).first())
