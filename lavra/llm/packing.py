"""Packing of tokenized texts into sequences of a fixed capacity.

Texts become token ids and one end id; those longer than the capacity are cut into pieces
of the capacity, the last one shorter. Which lengths share a sequence is decided on the
counts of the lengths alone, an array of ``capacity`` entries: from the longest length
down, a gap is closed exactly by one, two or three available lengths whose sum is the gap
(found by complement: an index tells which totals one, two and three available lengths
have, and the lengths of a total are looked up in the array of counts), as many times at once as the counts allow; if no combination closes it, the
longest length that fits goes in and the smaller gap is tried again. Every length is then
a row of runs (ranks from a to b go to sequences s, s+1, ... at offset o), and pieces find
theirs by their rank among the pieces of equal length. The rank is the place within the
task plus the number in earlier tasks, so no group of equal lengths meets in one task.

NULL counts as an empty text: its one end id is packed like any other. Repeated rows are
packed one by one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.chunks import text_slices
from lavra.llm.common import map_batches, stored
from lavra.llm.token_files import BatchTokenizer, batch_tokenizer

CAPACITY = 2048
END_ID = 0
SLICE_BYTES = 2 << 20


class ChunkTokenizer:
    """Ids of single texts; tasks encode many at once (see ``BatchTokenizer``)."""

    def __init__(self, content: bytes):
        self.batch = BatchTokenizer(content)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        return self.batch.encode(pa.array([text], pa.large_string()))[0].tobytes()


@dataclass
class Runs:
    """Where the pieces of each length go, sorted by ``length << 40 | first rank``."""

    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan_packing(counts: np.ndarray) -> Runs:
    """Runs for ``counts[length]`` pieces; the capacity is the last length."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    capacity = len(left) - 1
    used = np.zeros_like(left)
    sums = Sums(left)
    rows: list[tuple[int, int, int]] = []
    sequence = 0
    for length in range(capacity, 0, -1):
        while left[length]:
            parts = [length]
            left[length] -= 1
            gap = capacity - length
            while gap:
                exact = _exact(left, gap, sums)
                if exact:
                    parts += exact
                    break
                fitting = np.flatnonzero(left[1 : gap + 1])
                if not len(fitting):
                    break
                parts.append(int(fitting[-1]) + 1)
                left[parts[-1]] -= 1
                gap -= parts[-1]
            else:
                exact = []
            # Undo the trial, then take the combination as often as the counts allow.
            for part in parts[: len(parts) - len(exact or [])]:
                left[part] += 1
            times = min(int(left[p]) // m for p, m in Counter(parts).items())
            offset = 0
            for part in parts:
                rows.append((part << 40 | int(used[part]), sequence, offset))
                used[part] += times
                left[part] -= times
                offset += part
            sequence += times
            if not all(left[part] for part in parts):
                sums = Sums(left)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    return Runs(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), sequence)


class Sums:
    """Index of the totals that one, two and three available lengths have, a bit each.

    A length may stand in a total more often than it is available, so a bit says that there
    may be a combination; no bit, that there is none. It holds until a length runs out.
    """

    def __init__(self, left: np.ndarray):
        lengths = np.flatnonzero(left).tolist()
        within = (1 << len(left)) - 1
        self.one = self.two = self.three = 0
        for length in lengths:
            self.one |= 1 << length
        for length in lengths:
            self.two |= self.one << length & within
        for length in lengths:
            self.three |= self.two << length & within


def _exact(left: np.ndarray, gap: int, sums: Sums) -> list[int] | None:
    """One, two or three available lengths that sum to ``gap``, the longest first."""
    if sums.one >> gap & 1 and left[gap]:
        return [gap]
    pair = _pair(left, gap, gap - 1) if sums.two >> gap & 1 else None
    if pair:
        return pair
    if not sums.three >> gap & 1:
        return None
    # The longest of three is at least a third of the gap.
    for longest in (np.flatnonzero(left[(gap + 2) // 3 : gap - 1]) + (gap + 2) // 3)[::-1]:
        left[longest] -= 1
        pair = _pair(left, gap - int(longest), int(longest))
        left[longest] += 1
        if pair:
            return [int(longest), *pair]
    return None


def _pair(left: np.ndarray, total: int, most: int) -> list[int] | None:
    """Two available lengths that sum to ``total``, none above ``most``."""
    low = max(1, total - most)
    high = total // 2
    if low > high:
        return None
    small = np.minimum(left[low : high + 1], 1)
    large = np.minimum(left[total - high : total - low + 1][::-1], 1)
    both = small + large == 2
    if 2 * high == total and left[high] < 2:
        both[-1] = False
    at = int(both.argmax())
    return [total - low - at, low + at] if both[at] else None


def cut_pieces(
    frame: DataFrame, vocabulary_file: str, key: str, text: str, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of every text with their task and their place among its equal lengths."""
    content = frame.sparkSession.sparkContext.broadcast(Path(vocabulary_file).read_bytes())
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = batch_tokenizer(content.value)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for rows in text_slices(batches, 1, SLICE_BYTES):
            ids, ends = tokenizer.encode(rows.column(1))
            raw = memoryview(np.insert(ids, ends, END_ID)).cast("B")
            begin = 0
            row_of: list[int] = []
            piece, start, length, crc, place = [], [], [], [], []
            for i, end in enumerate((ends + np.arange(1, len(ends) + 1)).tolist()):
                for k, at in enumerate(range(begin, end, capacity)):
                    n = min(capacity, end - at)
                    row_of.append(i)
                    piece.append(k)
                    start.append(at - begin)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
                    place.append(seen[n])
                    seen[n] += 1
                begin = end
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(row_of, pa.int32())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    pa.array([task] * len(piece), pa.int32()),
                    pa.array(place, pa.int64()),
                ],
                names=[key, "piece", "start", "length", "ids_crc32", "task", "place"],
            )

    return map_batches(
        frame.select(key, text),
        run,
        f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, "
        "task int, place long",
    )


def pack(
    frame: DataFrame,
    vocabulary_file: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of all texts with the sequence and the offset they are packed at."""
    pieces = stored(cut_pieces(frame, vocabulary_file, key, text, capacity), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task")
    bases = per_task.select(
        F.col("length").alias("__length"),
        F.col("task").alias("__task"),
        (F.sum("n").over(earlier) - F.col("n")).alias("base"),
    )
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    runs = frame.sparkSession.sparkContext.broadcast(plan_packing(counts))
    kind = frame.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        for rows in batches:
            rank = rows.column(5).to_numpy() + rows.column(6).to_numpy()
            wanted = rows.column(3).to_numpy() << 40 | rank
            at = np.searchsorted(table.first, wanted, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns[:5],
                    pa.array(table.sequence[at] + wanted - table.first[at], pa.int64()),
                    pa.array(table.offset[at], pa.int64()),
                ],
                names=[*rows.schema.names[:5], "sequence_id", "offset"],
            )

    ranked = pieces.join(
        bases, (F.col("length") == F.col("__length")) & (F.col("task") == F.col("__task"))
    ).select(key, "piece", "start", "length", "ids_crc32", "place", "base")
    return map_batches(
        ranked,
        place,
        f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
