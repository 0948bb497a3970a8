"""Helpers of the corpus operators: bounded slices of texts, stored tables, hold-outs."""

from __future__ import annotations

import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lavra
from lavra.session import scratch_path

SLICE_CHARS = 1 << 20
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: later steps start from files."""
    return stored_twice(frame, label)[0]


def stored_twice(frame: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The same as two readings, which can be put together without mixing up columns."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    read = spark.read.schema(frame.schema)
    return read.parquet(path), read.parquet(path)


def release(spark: SparkSession) -> None:
    """Have memory cleared of finished plans. Spark deletes the shuffle files of plans that
    nothing refers to, but only once the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(lavra.__file__).parent
        base = str(Path(tempfile.mkdtemp(prefix="lavra-code-")) / "lavra_code")
        context.addPyFile(shutil.make_archive(base, "zip", root.parent, root.name))
        _shipped.add(context.applicationId)


def map_batches(
    frame: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts.

    The batch size is a session setting read when the plan is made; a session that
    already has a smaller one keeps it. A process serves the tasks of many stages, so what
    Arrow holds in reserve goes back at the end of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    ship(frame.sparkSession)
    conf, key = frame.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    # Spark gathers a batch in buffers outside the heap, twice as large and more.
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(key).removesuffix("b")
    if not (held.isdigit() and 0 < int(held) <= BATCH_BYTES):
        conf.set(key, str(BATCH_BYTES))
    return frame.mapInArrow(run, schema)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a value as text, modulo ``modulus``; NULL for NULL."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus))


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from training; a NULL identifier is not."""
    return F.coalesce(crc_mod(column, modulus) == remainder, F.lit(False))


def slices(lengths: Sequence[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most ``limit`` in total, or of one item."""
    start = total = 0
    for i, length in enumerate(lengths):
        if i > start and total + length > limit:
            yield start, i
            start, total = i, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


class Memo:
    """Remembers values of short keys in a bounded table.

    Two generations: once the young one is full it becomes the old one, from which keys
    that are asked for again move on; the rest is forgotten with the next change.
    """

    def __init__(self, entries: int, key_chars: int):
        self.entries, self.key_chars = entries, key_chars
        self.young: dict = {}
        self.old: dict = {}

    def values(self, keys: Sequence[str], compute: Callable[[list[str]], Sequence]) -> list:
        """The value of each key; ``compute`` gives those of keys not remembered."""
        found = list(map(self.young.get, keys))
        if None in found:
            missing = {k for k, v in zip(keys, found, strict=True) if v is None}
            known = {k: v for k in missing if (v := self.old.get(k)) is not None}
            new = [k for k in missing if k not in known]
            known.update(zip(new, compute(new), strict=True))
            found = [known[k] if v is None else v for k, v in zip(keys, found, strict=True)]
            if len(self.young) > self.entries:
                self.young, self.old = {}, self.young
            self.young.update((k, v) for k, v in known.items() if len(k) <= self.key_chars)
        return found


def batch(columns: dict[str, Sequence], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch with the columns in the order of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], field.type) for field in schema], schema=schema
    )
