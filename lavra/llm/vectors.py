"""Near-duplicate vectors with navigable small-world graphs, one per shard.

Equal vectors are one class. Classes are dealt to shards by a hash; each shard builds a
hierarchical graph: nodes get levels at random, every node is linked to near and diverse
nodes of its level, and a search goes down the levels and widens at the lowest one. Every
class is searched for in every shard, in blocks of queries. A shard's graph goes to its blocks in
parts; a task holds one graph and some thousand queries at a time. A query whose beam holds only
links is searched for again with a beam twice as wide. Of the queries held a sample
is audited against all vectors of the shard, and so are planted queries that have a link each;
below ``AUDIT_RECALL`` of either all of them are searched with a beam twice as wide. A beam as wide as a part of the shard is a scan.
Cosines of what was found are taken in double precision; links below the threshold go.

Within a task, links are joined to a forest and only its edges leave, so a dense group
gives as many rows as it has members. Shards number at least ``LEAST_SHARDS``, and more
once they would hold over ``SHARD_ROWS`` vectors.

Vectors that are NULL or zero or hold NULL or non-finite components link with nothing.
Vectors of different lengths do not link. Repeated rows of one identifier are vectors of
their own and link with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import map_batches, ship, stored
from lavra.llm.components import Forest, components, hot_join

THRESHOLD = 0.95
SHARD_ROWS = 1 << 16
QUERY_ROWS = 1 << 15
TASKS = 32  # of searches, for which graphs are copied
HELD_QUERIES = 1 << 13
PART_BYTES = 1 << 17  # rows of half a MB and more are costly for the JVM
QUERY = 2**31 - 1  # the part that rows of queries have; those of graphs count from 0
NO_CLASS = -(2**63)
LEAST_SHARDS = 8
LINKS = 16  # of a node at upper levels; twice as many at the lowest
BUILD_BEAM = 48
SEARCH_BEAM = 32
EXPANDED = 4  # nodes of a beam opened at a time
STEP_QUERIES = 256
AUDIT_QUERIES = 64
AUDIT_RECALL = 0.98
PLANTED_SLACK = 0.1  # of the way from the threshold to 1 that planted queries link with
SLACK = 1e-4  # single-precision cosines this far below the threshold are checked
SEED = 20240801


class Graph:
    """A hierarchical small-world graph over unit vectors (rows, single precision)."""

    def __init__(self, unit: np.ndarray, links: list[np.ndarray], entry: int):
        self.unit, self.links, self.entry = unit, links, entry

    @classmethod
    def build(cls, unit: np.ndarray) -> Graph:
        n = len(unit)
        rng = np.random.default_rng(SEED)
        level = np.minimum(
            (-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int), 12
        )
        order = rng.permutation(n)
        links: list[np.ndarray] = []
        for height in range(int(level.max(initial=0)) + 1):
            width = LINKS if height else 2 * LINKS
            links.append(np.full((n, width), -1, np.int32))
        graph = cls(unit, links, int(order[0]) if n else -1)
        # The upper levels first: they lead the searches that build the lower ones.
        for height in range(len(links) - 1, -1, -1):
            members = order[level[order] >= height]
            if height == len(links) - 1:
                graph.entry = int(members[0])
            done = 0
            while done < len(members):
                batch = members[done : done + max(32, min(done, 1024))]
                graph._insert(batch, members[:done], height)
                done += len(batch)
        return graph

    def _insert(self, batch: np.ndarray, present: np.ndarray, height: int) -> None:
        among = self.unit[batch] @ self.unit[batch].T
        np.fill_diagonal(among, -2)
        take = min(BUILD_BEAM, len(batch) - 1)
        near = np.argpartition(-among, take - 1, axis=1)[:, :take] if take > 0 else np.zeros((len(batch), 0), int)
        ids = batch[near].astype(np.int64)
        sims = np.take_along_axis(among, near, 1)
        if len(present):
            for at in range(0, len(batch), STEP_QUERIES):
                part = slice(at, at + STEP_QUERIES)
                found, values = self._beam(self.unit[batch[part]], BUILD_BEAM, height, int(present[0]))
                if at == 0:
                    old_ids = np.full((len(batch), BUILD_BEAM), -1)
                    old_sims = np.full((len(batch), BUILD_BEAM), -2.0, np.float32)
                old_ids[part], old_sims[part] = found, values
            ids, sims = np.hstack([ids, old_ids]), np.hstack([sims, old_sims])
        width = self.links[height].shape[1]
        chosen = self._diverse(batch, ids, sims, width // 2)
        self.links[height][batch, : chosen.shape[1]] = chosen
        self._link_back(batch, chosen, height)

    def _diverse(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Near nodes, those first that are nearer to the node than to any one taken."""
        keep = min(BUILD_BEAM, ids.shape[1])
        order = np.argsort(-sims, axis=1, kind="stable")[:, :keep]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        vectors = self.unit[np.maximum(ids, 0)]
        taken = np.zeros(ids.shape, bool)
        nearest = np.full(ids.shape, -2.0, np.float32)  # to those taken
        for k in range(keep):
            good = (ids[:, k] >= 0) & (sims[:, k] > nearest[:, k]) & (taken.sum(1) < most)
            taken[:, k] = good
            rows = np.flatnonzero(good)
            if len(rows):
                to = np.matmul(vectors[rows], vectors[rows, k][:, :, None])[:, :, 0]
                nearest[rows] = np.maximum(nearest[rows], to)
        rank = np.argsort(np.where(ids < 0, 2, ~taken), axis=1, kind="stable")[:, :most]
        return np.take_along_axis(ids, rank, 1).astype(np.int32)

    def _link_back(self, nodes: np.ndarray, chosen: np.ndarray, height: int) -> None:
        """Links from the chosen nodes back; full nodes keep the most diverse ones."""
        table = self.links[height]
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(heads), 2048):
            head, start, size = heads[at : at + 2048], first[at : at + 2048], count[at : at + 2048]
            width = int(size.max())
            place = start[:, None] + np.arange(width)
            new = np.where(np.arange(width) < size[:, None], source[np.minimum(place, len(source) - 1)], -1)
            both = np.hstack([table[head], new]).astype(np.int64)
            # A node that is linked already counts once.
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            sims = np.where(
                both >= 0,
                np.matmul(self.unit[np.maximum(both, 0)], self.unit[head][:, :, None])[:, :, 0],
                np.float32(-2),
            )
            kept = self._diverse(head, both, sims, table.shape[1])
            table[head] = -1
            table[head, : kept.shape[1]] = kept

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes found for each query (-1 where fewer) and their cosines."""
        n = len(self.unit)
        if beam * 4 >= n:
            sims = queries @ self.unit.T
            if beam >= n:
                return np.broadcast_to(np.arange(n), sims.shape), sims
            ids = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            return ids, np.take_along_axis(sims, ids, 1)
        entry = np.full(len(queries), self.entry)
        for height in range(len(self.links) - 1, 0, -1):
            entry = self._descend(queries, entry, height)
        return self._beam(queries, beam, 0, entry)

    def _descend(self, queries: np.ndarray, at: np.ndarray, height: int) -> np.ndarray:
        best = np.einsum("qd,qd->q", queries, self.unit[at])
        while True:
            near = self.links[height][at]
            sims = np.matmul(self.unit[np.maximum(near, 0)], queries[:, :, None])[:, :, 0]
            sims[near < 0] = -2
            k = sims.argmax(1)
            rows = np.arange(len(queries))
            better = sims[rows, k] > best
            if not better.any():
                return at
            at = np.where(better, near[rows, k], at)
            best = np.where(better, sims[rows, k], best)

    def _beam(self, queries: np.ndarray, beam: int, height: int, entry) -> tuple[np.ndarray, np.ndarray]:
        q, n = len(queries), len(self.unit)
        rows = np.arange(q)
        entry = np.broadcast_to(np.asarray(entry), q)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -2.0, np.float32)
        opened = np.ones((q, beam), bool)
        ids[:, 0] = entry
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.unit[entry])
        opened[:, 0] = False
        seen = np.zeros((q, n + 1), bool)
        seen[rows, entry] = True
        while True:
            waiting = np.where(opened, np.float32(-3), sims)
            step = min(EXPANDED, beam)
            pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            usable = np.take_along_axis(waiting, pick, 1) > -2
            live = np.flatnonzero(usable.any(1))
            if not len(live):
                return ids, sims
            pick, usable = pick[live], usable[live]
            opened[live[:, None], pick] = True
            near = self.links[height][np.where(usable, ids[live[:, None], pick], 0)]
            near = np.where(usable[:, :, None], near, -1).reshape(len(live), -1)
            near[seen[live[:, None], near]] = -1  # -1 looks up the spare last place
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            width = int((near >= 0).sum(1).max(initial=0))
            if not width:
                continue
            near = -np.sort(-near, axis=1)[:, :width]
            seen[live[:, None], near] = True
            seen[:, n] = False
            new = np.matmul(self.unit[np.maximum(near, 0)], queries[live][:, :, None])[:, :, 0]
            new[near < 0] = -2
            all_ids = np.hstack([ids[live], near])
            all_sims = np.hstack([sims[live], new])
            all_opened = np.hstack([opened[live], near < 0])
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, top, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            opened[live] = np.take_along_axis(all_opened, top, 1)


def _matrix(blobs: list) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def find_links(
    graph: Graph, vectors: np.ndarray, queries: np.ndarray, threshold: float
) -> list[np.ndarray]:
    """For each query the rows of ``vectors`` found at or above the threshold.

    Few queries may have a link, so those audited may have none. Planted queries have one
    each: a vector of the shard, turned so far that it just links. Both recalls must do.
    """
    if not len(queries):
        return []
    rng = np.random.default_rng(SEED)
    audited = rng.permutation(len(queries))[:AUDIT_QUERIES]
    sources = rng.permutation(len(vectors))[:AUDIT_QUERIES]
    planted = turned(vectors[sources], threshold + (1 - threshold) * PLANTED_SLACK, rng)
    beam = SEARCH_BEAM
    while True:
        hits = _search_all(graph, vectors, planted, threshold, beam)
        recall = np.mean([source in rows for source, rows in zip(sources, hits, strict=True)])
        if recall >= AUDIT_RECALL or beam >= len(vectors):
            found = _search_all(graph, vectors, queries, threshold, beam)
            true = _check(
                vectors, queries[audited], [np.arange(len(vectors))] * len(audited), threshold
            )
            recall = audit_recall(vectors, queries[audited], [found[i] for i in audited], true)
            if recall >= AUDIT_RECALL or beam >= len(vectors):
                return found
        beam *= 2


def turned(vectors: np.ndarray, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """Each vector turned in some direction until it has this cosine with what it was."""
    if vectors.shape[1] < 2:
        return vectors
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / norm
    away = rng.normal(size=vectors.shape)
    away -= np.sum(away * unit, axis=1, keepdims=True) * unit
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    return norm * (cosine * unit + np.sqrt(1 - cosine**2) * away)


def audit_recall(
    vectors: np.ndarray, queries: np.ndarray, found: list[np.ndarray], true: list[np.ndarray]
) -> float:
    """Mean share of the true links that are found, over queries with a link to another vector."""
    shares = []
    for query, got, rows in zip(queries, found, true, strict=True):
        others = rows[(vectors[rows] != query).any(1)]
        if len(others):
            shares.append(np.isin(others, got).mean())
    return float(np.mean(shares)) if shares else 1.0


def _search_all(
    graph: Graph, vectors: np.ndarray, queries: np.ndarray, threshold: float, beam: int
) -> list[np.ndarray]:
    found: list[np.ndarray] = [np.zeros(0, int)] * len(queries)
    unit = _unit(queries)
    waiting = np.arange(len(queries))
    while len(waiting):
        full = []
        for at in range(0, len(waiting), STEP_QUERIES):
            part = waiting[at : at + STEP_QUERIES]
            ids, sims = graph.search(unit[part], beam)
            near = sims >= threshold - SLACK
            if beam < len(vectors):
                full.append(part[near.all(1)])
            hits = [row[mask] for row, mask in zip(ids, near, strict=True)]
            for i, rows in zip(part, _check(vectors, queries[part], hits, threshold), strict=True):
                found[i] = rows
        waiting = np.concatenate(full) if full else np.zeros(0, int)
        beam *= 2
    return found


def _check(
    vectors: np.ndarray, queries: np.ndarray, hits: list[np.ndarray], threshold: float
) -> list[np.ndarray]:
    """Of the hits those whose cosine in double precision reaches the threshold."""
    checked = []
    for query, rows in zip(queries, hits, strict=True):
        if len(rows):
            near = vectors[rows]
            cosine = near @ query / (np.linalg.norm(near, axis=1) * np.linalg.norm(query))
            rows = rows[cosine >= threshold]
        checked.append(rows)
    return checked


def vector_rows(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """Identifier, digest and bytes of each vector; both NULL where it cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            digests, blobs = [], []
            for value in rows.column(1).to_pylist():
                usable = value is not None and None not in value
                x = np.asarray(value if usable else [], np.float64) + 0.0  # no negative zeros
                norm = np.linalg.norm(x)
                usable = usable and np.isfinite(norm) and norm > 0
                blob = x.tobytes() if usable else None
                blobs.append(blob)
                digests.append(usable and hashlib.blake2b(blob, digest_size=16).hexdigest() or None)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(digests, pa.string()), pa.array(blobs, pa.binary())],
                names=["vec_id", "digest", "vector"],
            )

    chosen = frame.select(F.col(key).cast("long").alias("vec_id"), F.col(vector))
    return map_batches(chosen, run, "vec_id long, digest string, vector binary")


def _build_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The graph of a shard, in parts of ``PART_BYTES`` so that no row is large."""
    rows = pa.Table.from_batches(batches)
    classes = rows["class_id"].fill_null(NO_CLASS).to_numpy()
    order = np.argsort(classes, kind="stable")
    vectors = _matrix(rows["vector"].to_pylist())[order]
    graph = Graph.build(_unit(vectors))
    shard = rows["shard"][0].as_py()
    head = np.array([*vectors.shape, len(graph.links), graph.entry], np.int64)
    arrays = [head, classes[order], rows["size"].to_numpy()[order], vectors, *graph.links]
    whole = b"".join(x.tobytes() for x in arrays)
    for part, at in enumerate(range(0, len(whole), PART_BYTES)):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int64()), pa.array([part], pa.int32()),
                pa.array([whole[at : at + PART_BYTES]], pa.binary()),
            ],
            names=["shard", "part", "payload"],
        )


def _load(parts: list[bytes]) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    whole = b"".join(parts)
    n, width, levels, entry = np.frombuffer(whole, np.int64, 4).tolist()
    at = 32

    def take(kind: type, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(whole, kind, count, at)
        at += found.nbytes
        return found

    classes, sizes = take(np.int64, n), take(np.int64, n)
    vectors = take(np.float64, n * width).reshape(n, width)
    tables = [LINKS if height else 2 * LINKS for height in range(levels)]
    links = [take(np.int32, n * table).reshape(n, table) for table in tables]
    return Graph(_unit(vectors), links, entry), vectors, classes, sizes


class _Block:
    """A shard's graph and the queries of a block, of which a few thousand are held at a time."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.ids: list[int] = []
        self.queries: list[bytes] = []
        self.loaded: tuple | None = None
        self.forest = Forest()
        self.total: dict[int, int] = {}

    def add(self, rows: pa.RecordBatch, threshold: float) -> None:
        """Rows of the block: parts of the graph in order, then queries."""
        parts = int(np.count_nonzero(rows.column(2).to_numpy() < QUERY))
        self.parts += rows.column(4).slice(0, parts).to_pylist()
        self.ids += rows.column(3).slice(parts).fill_null(NO_CLASS).to_pylist()
        self.queries += rows.column(4).slice(parts).to_pylist()
        if len(self.ids) >= HELD_QUERIES:
            self.search(threshold)

    def search(self, threshold: float) -> None:
        if self.parts:
            self.loaded, self.parts = _load(self.parts), []
        if self.loaded and self.ids:
            graph, vectors, classes, sizes = self.loaded
            found = find_links(graph, vectors, _matrix(self.queries), threshold)
            for node, hits in zip(self.ids, found, strict=True):
                hits = hits[classes[hits] != node]
                if len(hits):
                    self.total[node] = int(sizes[hits].sum())
                    for other in classes[hits].tolist():
                        self.forest.union(node, other)
        self.ids, self.queries = [], []

    def nodes(self) -> Iterator[pa.RecordBatch]:
        nodes = [(node, self.total.get(node, 0), root) for node, root in self.forest.edges()]
        for low in range(0, len(nodes), 10_000):
            columns = zip(*nodes[low : low + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])


def search_blocks(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """node, links and root of what the queries find, from rows by shard, block and part."""
    key, block = None, _Block()
    for rows in batches:
        keys = np.stack([rows.column(0).to_numpy(), rows.column(1).to_numpy()], 1)
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))[: len(rows)]
        for low, high in zip(starts, [*starts[1:], len(rows)], strict=True):
            if key != (key := tuple(keys[low].tolist())):
                block.search(threshold)
                yield from block.nodes()
                block = _Block()
            block.add(rows.slice(low, high - low), threshold)
    block.search(threshold)
    yield from block.nodes()


def near_duplicates(
    frame: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable) and kept for each row."""
    spark = frame.sparkSession
    ship(spark)
    rows = stored(vector_rows(frame, key, vector), "vectors")
    classes = (
        rows.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("vec_id").alias("class_id"),
            F.count(F.lit(1)).alias("size"),
            F.max("vector").alias("vector"),
        )
    )
    classes = stored(classes, "classes")
    n = classes.count()
    shards = max(LEAST_SHARDS, -(-n // SHARD_ROWS))
    # Every block of a shard gets a copy of its graph: no more than make enough tasks.
    blocks = max(1, min(-(-n // QUERY_ROWS), -(-TASKS // shards)))
    dealt = classes.withColumn("length", F.octet_length("vector").cast("long"))
    graphs = (
        dealt.withColumn(
            "shard", F.col("length") * shards + F.pmod(F.xxhash64("digest"), F.lit(shards))
        )
        .select("shard", "class_id", "size", "vector")
        .groupBy("shard")
        .applyInArrow(_build_shard, "shard long, part int, payload binary")
    )
    graphs = stored(graphs, "graphs").select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "part",
        F.lit(None).cast("long").alias("class_id"),
        "payload",
    )
    queries = dealt.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(shards - 1)),
                lambda s: F.col("length") * F.lit(shards) + s,
            )
        ).alias("shard"),
        F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
        F.lit(QUERY).alias("part"),
        "class_id",
        F.col("vector").alias("payload"),
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * shards * blocks)
    together = graphs.unionByName(queries).repartition(tasks, "shard", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return search_blocks(batches, threshold)

    found = map_batches(
        together.sortWithinPartitions("shard", "block", "part"), search, "node long, links long, root long"
    )
    found = stored(found, "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.select("digest", "class_id", "size")
        .join(linked, F.col("class_id") == F.col("node"), "left")
        .drop("node")
        .join(roots, F.col("class_id") == F.col("node"), "left")
        .select(
            "digest",
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class_id").alias("component"),
        )
    )
    return hot_join(rows.select("vec_id", "digest"), per_class, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
