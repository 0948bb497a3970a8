"""Hard negatives by exact integer inner products: Strassen's recursion on tiles.

Components become floor(256 x) as 64-bit numbers. Anchors are taken in blocks of bounded
size; for each block, tasks go over all rows in tiles and multiply the block with each tile:
seven products of quarter size in place of eight, down to a leaf, with zeros added where a
side is odd. Additions and products are of integers modulo 2^64, so the result is exact
whenever it fits 64 bits, whatever the intermediate sums. A leaf whose products and sums
stay below 2^53 is multiplied as doubles, which is exact too and faster.

Tasks keep two kinds of bounded heaps per anchor, as sorted arrays: the best rows of the
anchor's label, and for each positive so found the best rows of other labels whose score is
in the positive's window. Heaps of different tasks are merged by a shuffle on the anchor.

Rows with a NULL identifier, label or vector, or with a component that is NULL or not finite,
take no part. Repeated rows are rows of their own. Equal scores go by identifier, then by
place. Of vectors of different length the shorter count as ended by zeros; empty vectors
score 0. Vectors so large that a score might not fit 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lavra.llm.common import map_batches, stored
from lavra.session import scratch_path

SCALE = 256
ANCHORS_OF = 50
RELABELLED = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
BLOCK_ANCHORS = 4096
TILE_ANCHORS = 1024
TILE_ROWS = 2048
LEAF = 32
NONE = np.iinfo(np.int64).min
SCHEMA = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A leaf: as doubles where nothing can be rounded, else modulo 2^64."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53 and min(a.min(initial=0), b.min(initial=0)) > NONE:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two matrices of 64-bit integers, modulo 2^64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return product(a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    h, i, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    c = np.empty((m, n), np.int64)
    c11, c12, c21, c22 = c[:h, :j], c[:h, j:], c[h:, :j], c[h:, j:]
    c11[:] = c22[:] = strassen(a11 + a22, b11 + b22, leaf)
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c21 += p
    c11 += p
    p = strassen(a11 + a12, b22, leaf)
    c12 += p
    c11 -= p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return c


class Heaps:
    """The ``size`` best (score, identifier, row number) of each of ``rows``, best first."""

    def __init__(self, rows: int, size: int):
        self.size = size
        self.score = np.full((rows, size), NONE)
        self.name = np.zeros((rows, size), np.int64)
        self.place = np.zeros((rows, size), np.int64)

    def add(self, at: np.ndarray, scores: np.ndarray, names: np.ndarray, places: np.ndarray):
        """Scores of rows ``at`` with columns of these names and places; NONE is no entry.

        Columns are sorted by name and place. Rows without a score as good as their worst
        entry are passed over.
        """
        hopeful = (scores >= self.score[at, -1:]) & (scores > NONE)
        rows = np.flatnonzero(hopeful.any(axis=1))
        if not len(rows):
            return
        at, scores = at[rows], scores[rows]
        best = self._best(scores, min(self.size, scores.shape[1]))
        score = np.concatenate([self.score[at], np.take_along_axis(scores, best, 1)], 1)
        name = np.concatenate([self.name[at], names[best]], 1)
        place = np.concatenate([self.place[at], places[best]], 1)
        # Sorted upwards and turned round: the lowest of 64-bit numbers has no negative.
        order = np.lexsort((-place, -name, score), axis=1)[:, ::-1][:, : self.size]
        self.score[at] = np.take_along_axis(score, order, 1)
        self.name[at] = np.take_along_axis(name, order, 1)
        self.place[at] = np.take_along_axis(place, order, 1)

    def _best(self, scores: np.ndarray, k: int) -> np.ndarray:
        """Columns of the k best scores of each row, the first column among equal ones."""
        width = scores.shape[1]
        last = np.arange(width - 1, -1, -1)
        low, high = scores[scores > NONE].min(initial=0), scores.max(initial=0)
        if max(-int(low), int(high)) < 2**62 // width:
            # One number for score and column, so that no two are equal.
            key = np.where(scores > NONE, scores * width + last, NONE)
            return np.argpartition(key, width - k, axis=1)[:, width - k :]
        return np.argsort(scores[:, ::-1], axis=1, kind="stable")[:, ::-1][:, :k] * -1 + width - 1

    def rows(self, anchors: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        found = self.score > NONE
        yield (
            np.broadcast_to(anchors[:, None], found.shape)[found],
            self.score[found],
            self.name[found],
            self.place[found],
        )


def prepared(
    frame: DataFrame, key: str, vector: str, label: str, relabelled: int, labels: int
) -> DataFrame:
    """(id, label, components, place): rows that take part, in the shared folder."""
    value = F.col(vector)
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    number = F.col(key).cast("long")
    old = F.col(label).cast("long")
    changed = F.when(F.pmod(number, F.lit(relabelled)) == 0, F.pmod(old + 1, F.lit(labels)))
    rows = frame.filter(number.isNotNull() & old.isNotNull() & value.isNotNull() & finite).select(
        number.alias("id"),
        changed.otherwise(old).alias("label"),
        F.transform(value, lambda x: F.floor(SCALE * x.cast("double"))).alias("components"),
        F.aggregate(
            value, F.lit(0.0), lambda s, x: s + F.pow(F.floor(SCALE * x.cast("double")), F.lit(2.0))
        ).alias("square"),
        F.monotonically_increasing_id().alias("place"),
    )
    return stored(rows, "vectors")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of components, ended by zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, labels, places, matrix) of up to ``TILE_ROWS`` rows, sorted by id and place."""
    for rows in batches:
        for start in range(0, rows.num_rows, TILE_ROWS):
            part = rows.slice(start, TILE_ROWS)
            ids, labels, places = (
                part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3)
            )
            order = np.lexsort((places, ids))
            values = matrix(part.column(2), width)[order]
            yield ids[order], labels[order], places[order], values


def mine(
    frame: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    anchors_of: int = ANCHORS_OF,
    relabelled: int = RELABELLED,
    labels: int = LABELS,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, for each anchor's first
    ``positives`` rows of its label and the first ``negatives`` rows of other labels whose
    score is between ``low`` and ``high`` hundredths of the positive's."""
    spark = frame.sparkSession
    rows = prepared(frame, key, vector, label, relabelled, labels)
    is_anchor = F.pmod(F.col("id"), F.lit(anchors_of)) == 0
    size = rows.agg(
        F.max(F.size("components")), F.max("square"), F.count_if(is_anchor).alias("anchors")
    ).first()
    width, square = max(size[0] or 0, 1), size[1] or 0.0
    if square >= 2.0**62 / max(low, high, 100):
        raise ValueError("inner products might not fit 64 bits")
    blocks = -(-size["anchors"] // block_anchors)
    path = scratch_path(spark, "hard-negatives")
    anchors = rows.filter(is_anchor).withColumn(
        "block", F.pmod(F.xxhash64("place"), F.lit(max(blocks, 1)))
    )
    if blocks > 1:
        anchors = stored(anchors, "anchors")
    for block in range(blocks):
        _mine_block(
            spark, rows, anchors.filter(F.col("block") == block), width,
            positives, negatives, low, high, f"{path}/block={block}",
        )
    if not blocks:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(
        *[f"{path}/block={block}" for block in range(blocks)]
    )


def _mine_block(
    spark: SparkSession, rows: DataFrame, block: DataFrame, width: int,
    positives: int, negatives: int, low: int, high: int, path: str,
) -> None:
    # Hashed to blocks of 4096 anchors on average; the table is one block's.
    table = block.select("id", "label", "components", "place").toArrow().combine_chunks()
    if not table.num_rows:
        spark.createDataFrame([], SCHEMA).write.parquet(path)
        return
    part = table.to_batches()[0]
    ids, labels, places = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
    order = np.lexsort((places, labels))
    values = matrix(part.column(2), width)[order]
    held = spark.sparkContext.broadcast((ids[order], labels[order], places[order], values))

    def best_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, of_label, of_place, left = held.value
        heaps = Heaps(len(left), positives)
        for names, kinds, spots, right in tiles(batches, width):
            for kind in np.unique(kinds):
                here = kinds == kind
                first, end = np.searchsorted(of_label, [kind, kind + 1])
                for a in range(first, end, TILE_ANCHORS):
                    at = np.arange(a, min(a + TILE_ANCHORS, end))
                    scores = strassen(left[at], right[here].T)
                    scores[of_place[at][:, None] == spots[here]] = NONE
                    heaps.add(at, scores, names[here], spots[here])
        yield from _batches(heaps.rows(np.arange(len(left))))

    schema = "anchor long, score long, name long, place long"
    candidates = map_batches(rows.select("id", "label", "components", "place"), best_positives, schema)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "name", "place")
    chosen = (
        candidates.withColumn("nth", F.row_number().over(first))
        .filter(F.col("nth") <= positives)
        .toArrow()
    )  # a few rows per anchor of the block
    score = np.full((len(ids), positives), NONE)
    name = np.zeros((len(ids), positives), np.int64)
    anchor, nth = chosen["anchor"].to_numpy(), chosen["nth"].to_numpy() - 1
    score[anchor, nth] = chosen["score"].to_numpy()
    name[anchor, nth] = chosen["name"].to_numpy()
    bounds = spark.sparkContext.broadcast((score, name))

    def best_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, of_label, _, left = held.value
        score, _ = bounds.value
        known = score > NONE
        # low * p <= 100 n <= high * p in whole numbers; an empty window stays empty.
        bottom = np.where(known, -(-(low * np.where(known, score, 0)) // 100), 1)
        top = np.where(known, high * np.where(known, score, 0) // 100, 0)
        heaps = [Heaps(len(left), negatives) for _ in range(positives)]
        for names, kinds, spots, right in tiles(batches, width):
            for a in range(0, len(left), TILE_ANCHORS):
                at = np.arange(a, min(a + TILE_ANCHORS, len(left)))
                scores = strassen(left[at], right.T)
                scores[of_label[at][:, None] == kinds] = NONE
                for k, heap in enumerate(heaps):
                    inside = (scores >= bottom[at, k, None]) & (scores <= top[at, k, None])
                    if inside.any():
                        heap.add(at, np.where(inside, scores, NONE), names, spots)
        for k, heap in enumerate(heaps):
            yield from _batches(heap.rows(np.arange(len(left)) * positives + k))

    candidates = map_batches(rows.select("id", "label", "components", "place"), best_negatives, schema)
    pairs = map_batches(
        candidates.withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= negatives)
        .select("anchor", "score", "name", "rank"),
        _named(held, bounds, positives),
        SCHEMA,
    )
    pairs.write.parquet(path)


def _named(held, bounds, positives: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = held.value[0]
        score, name = bounds.value
        for rows in batches:
            slot = rows.column(0).to_numpy(zero_copy_only=False)
            anchor, k = slot // positives, slot % positives
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[anchor]),
                    pa.array(name[anchor, k]),
                    rows.column(3).cast(pa.int32()),
                    rows.column(2),
                    pa.array(score[anchor, k]),
                    rows.column(1),
                ],
                names=[
                    "anchor_id", "positive_id", "rank", "negative_id",
                    "positive_score", "negative_score",
                ],
            )

    return run


def _batches(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in part],
            names=["anchor", "score", "name", "place"],
        )

