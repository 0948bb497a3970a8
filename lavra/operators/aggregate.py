"""Counts per group, distinct counts and coverage. Partial sums come before shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.numeric import percent
from lavra.functions.text import named


def group_counts(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[str | Column] = (),
    name: str = "n_rows",
) -> DataFrame:
    """Rows per group; NULL is a group of its own."""
    counted = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counted.orderBy(*order_by) if order_by else counted


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column its distinct values, without and with NULL as a value.

    Column and value are grouped together, so one shuffle serves all columns and
    each task sends a value once however often it occurs.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("column"), named(name).cast("string").alias("value"))
                    for name in columns
                ]
            )
        )
    )
    return (
        pairs.groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count("value").alias("n_distinct"), F.count("*").alias("n_distinct_with_null"))
    )


def key_coverage(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of the left table, how many the right one has, and the share.

    The keys of both tables meet in one aggregation (no join, hence no sort); a
    key sends one row per task.
    """
    sides = left.select(*on, F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select(*on, F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    has_null = F.expr(" OR ".join(f"`{key}` IS NULL" for key in on))
    per_key = (
        sides.groupBy(*on)
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
        .filter("l")
        .select((F.col("r") & ~has_null).alias("hit"))
    )
    total, found = F.count("*"), F.count_if("hit")
    return per_key.agg(
        total.alias("n_keys"),
        found.alias("found"),
        F.count_if(~F.col("hit")).alias("missing"),
        percent(found, total).alias("coverage_percent"),
    )


def row_coverage(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows for which any of the flags holds, those without, and the share."""
    hit = F.coalesce(F.greatest(*flags) if len(flags) > 1 else F.col(flags[0]), F.lit(False))
    total, found = F.count("*"), F.count_if(hit)
    return df.agg(
        total.alias("n_rows"),
        found.alias("found"),
        F.count_if(~hit).alias("missing"),
        percent(found, total).alias("coverage_percent"),
    )
