"""One record per key, and the keys that have several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.operators.join import semi_join


def canonical(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of each key in the order given.

    Rows that tie are told apart by the remaining columns (or ``tie_break``),
    so that a rerun picks the same row. Spark cuts each key to one row per input
    partition before it shuffles, so a key that holds a large part of the table
    sends no more than one row per task.
    """
    if tie_break is None:
        tie_break = [name for name in df.columns if name not in keys]
    order = [*order_by, *[F.col(name).asc() for name in tie_break]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows (``n_rows``)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys with several rows, and of the rows they hold; 0 when none."""
    return duplicate_keys(df, keys).agg(
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once (NULL keys match nothing)."""
    return semi_join(df, duplicate_keys(df, keys).select(*keys), keys)


def canonical_check(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys before and after choosing, and keys still held by several rows.

    One shuffle: both sides are counted per key in the same aggregation.
    """
    sides = before.select(*keys, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(*keys, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    per_key = sides.groupBy(*keys).agg(F.max("b").alias("b"), F.sum("a").alias("a"))
    return per_key.agg(
        F.count_if(F.col("b") > 0).alias("keys_before"),
        F.count_if(F.col("a") > 0).alias("keys_after"),
        F.count_if(F.col("a") > 1).alias("duplicated_after"),
    )
