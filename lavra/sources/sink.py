"""Parquet output whose row count is taken while writing and checked after."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import named
from lavra.operators.checksum import content_gate, content_sum
from lavra.operators.quality import Gate, expect


@dataclass(frozen=True)
class WriteResult:
    """A dataset just written and the rows that went into it."""

    path: str
    rows: int
    columns: int
    checksum: int | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet dataset, replaced as a whole by default.

    A partitioned dataset is not shuffled by its partition columns first: one
    value may hold much of the table, and would then be written by one task.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def counted_write(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), content: bool = False
) -> WriteResult:
    """Write and count in the same job, so the plan is not run a second time.

    ``content`` also takes the checksum of what is written (see ``content_sum``).
    """
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if content:
        measures.append(content_sum(df).alias("checksum"))
    write_parquet(df.observe(seen, *measures), path, partition_by)
    row = seen.get
    return WriteResult(path, row["rows"], len(df.columns), row.get("checksum"))


def write_verified(
    df: DataFrame,
    path: str,
    label: str,
    partition_by: Sequence[str] = (),
    content: bool = False,
) -> tuple[WriteResult, DataFrame]:
    """Write, and a report that compares what is stored with what was written.

    The stored rows are counted from Parquet footers; with ``content`` they are read and
    their checksum is compared with the one taken while writing, types included.
    """
    result = counted_write(df, path, partition_by, content)
    stored = result.read(df.sparkSession)
    gates = {f"{label}: rows stored": Gate(F.count(F.lit(1)), result.rows)}
    if content:
        # Types of partition columns are guessed from folder names; take those written.
        stored = stored.select(
            *[named(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        )
        gates[f"{label}: content kept"] = content_gate(stored, result.checksum)
    return result, expect(stored, gates)

def staged_path(path: str) -> str:
    """Where a dataset is written and checked before it takes the place of ``path``."""
    return f"{path.rstrip('/')}.staged"


def publish_staged(spark: SparkSession, path: str) -> None:
    """Put the staged dataset in the place of ``path``; the old one goes last.

    For plain folders that other tools read by their name: two renames, between which there is
    no table, and which copy on an object store. ``VersionedTable`` has neither drawback.
    """
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    staged, target = new_path(staged_path(path)), new_path(path)
    old = new_path(f"{path.rstrip('/')}.replaced")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(old, True)
    if store.exists(target) and not store.rename(target, old):
        raise OSError(f"{path} cannot be moved aside")
    if not store.rename(staged, target):
        raise OSError(f"{staged_path(path)} cannot be moved to {path}")
    store.delete(old, True)
