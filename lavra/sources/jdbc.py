"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTarget:
    """A table and how to reach it. ``properties`` holds user, password, driver."""

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "dbtable": self.table, **self.properties}


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table as one query, or split into parallel ones.

    Split by ranges of a number, date or timestamp column, or by a list of
    predicates (each row must satisfy exactly one of them).
    """
    if predicates:
        return spark.read.jdbc(
            target.url,
            target.table,
            predicates=list(predicates),
            properties={**target.properties, "fetchsize": str(fetch_size)},
        )
    reader = spark.read.format("jdbc").options(**target.options()).option("fetchsize", fetch_size)
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned read needs lower, upper and partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    connections: int = 16,
    batch_size: int = 10_000,
    truncate: bool = False,
    column_types: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a table from several tasks at once.

    ``connections`` bounds the open connections: Spark merges partitions down to
    it without a shuffle. ``truncate`` empties the table and keeps its definition,
    otherwise it is dropped and created anew. ``column_types`` sets the types
    of a table that is created.
    """
    writer = (
        df.write.mode(mode)
        .format("jdbc")
        .options(**target.options())
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .option("truncate", truncate)
    )
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()


def count_jdbc(spark: SparkSession, target: JdbcTarget) -> DataFrame:
    """Rows of a table (``n_rows``), counted by the database, not by fetching them."""
    return (
        spark.read.format("jdbc")
        .options(url=target.url, **target.properties)
        .option("query", f"SELECT COUNT(*) AS n_rows FROM {target.table}")
        .load()
        .toDF("n_rows")
    )


def jdbc_shape(spark: SparkSession, target: JdbcTarget) -> DataFrame:
    """Rows and columns of a table as the database itself sees it."""
    columns = len(read_jdbc(spark, target).columns)
    return count_jdbc(spark, target).withColumn("n_columns", F.lit(columns))
