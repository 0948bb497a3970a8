"""Connected components of an edge table, without gathering edges anywhere.

Large-star and small-star steps alternate until nothing changes: each links nodes to the
smallest neighbour, so paths shorten by half or more per round. The edge table is written
to the shared folder after each round, so a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import map_batches, stored

MOST_ROUNDS = 60
FOREST_NODES = 1_000_000


def hot_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` with a shuffle directly below both sides.

    Comparing a hash of the key too keeps earlier partitionings from being used again;
    only with the two shuffles can adaptive execution split a key with many rows.
    """
    right = right.withColumnRenamed(key, "__key")
    return left.join(
        right,
        (left[key] == right["__key"]) & (F.xxhash64(left[key]) == F.xxhash64(right["__key"])),
        how,
    ).drop("__key")


def components(edges: DataFrame) -> DataFrame:
    """(node, component), of type long, for every node ``a`` or ``b`` of an edge that is not the smallest
    of its component; loops and repeated edges do no harm, NULL ends are left out."""
    pairs = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    # A forest per task keeps what its edges connect, in as many edges as it has nodes.
    pairs = map_batches(pairs.repartition("u"), _forest_edges, "u long, v long").distinct()
    pairs = stored(pairs, "edges")
    seen = _signature(pairs)
    for _ in range(MOST_ROUNDS):
        if not seen[0]:
            break
        pairs = stored(_small_star(_large_star(pairs)), "edges")
        now = _signature(pairs)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _forest_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()

    def rows() -> pa.RecordBatch:
        pairs = [(node, root) for node, root in forest.edges() if node != root]
        forest.parent.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"]
        )

    for part in batches:
        for u, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            forest.union(u, v)
        if len(forest.parent) > FOREST_NODES:
            yield rows()
    yield rows()


def _signature(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        hot_join(both, least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = hot_join(pairs, least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


class Forest:
    """Union-find inside a task; the root of a tree is its smallest member."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, node: Hashable):
        parent = self.parent
        root = node
        while (up := parent.get(root, root)) != root:
            root = up
        while node != root:
            parent[node], node = root, parent.get(node, node)
        return root

    def union(self, a: Hashable, b: Hashable) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def edges(self) -> Iterable[tuple]:
        return ((node, self.find(node)) for node in list(self.parent))
