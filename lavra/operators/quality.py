"""Gates: measures compared with what they should be, as a report to enforce."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import is_blank, outside_domain


class QualityError(RuntimeError):
    """One or more gates failed."""


@dataclass(frozen=True)
class Gate:
    """An aggregate over a table and the value it must have; None is not checked."""

    measure: Column
    expected: int | None


def metrics(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Aggregates as rows (``check``, ``actual``), all from one pass."""
    labels = list(measures)
    row = df.agg(*[measures[label].alias(f"m{i}") for i, label in enumerate(labels)])
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("check"), F.col(f"m{i}").cast("long").alias("actual")
                    )
                    for i, label in enumerate(labels)
                ]
            )
        )
    )


def expect(df: DataFrame, gates: Mapping[str, Gate]) -> DataFrame:
    """Report (``check, actual, expected, ok``) of the gates on one table, in one pass.

    ``ok`` is NULL where nothing is expected.
    """
    measured = metrics(df, {label: gate.measure for label, gate in gates.items()})
    wanted = F.create_map(
        *[part for label, gate in gates.items() for part in (F.lit(label), F.lit(gate.expected))]
    )
    expected = wanted[F.col("check")].cast("long")
    return measured.select(
        "check",
        "actual",
        expected.alias("expected"),
        F.when(expected.isNotNull(), F.equal_null(F.col("actual"), expected)).alias("ok"),
    )


def compare_metrics(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Report on two sets of measures under the same labels, of two tables or stores.

    A label on one side only is a failed check.
    """
    return (
        actual.join(expected.withColumnRenamed("actual", "expected"), "check", "full")
        .select("check", "actual", "expected")
        .withColumn("ok", F.equal_null("actual", "expected"))
    )


def stack_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """Several reports as one."""
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Raise one error that names every failed check of a report."""
    failed = report.filter(~F.col("ok")).collect()
    if failed:
        raise QualityError(
            "; ".join(
                f"{row['check']}: found {row['actual']}, expected {row['expected']}"
                for row in failed
            )
        )


def domain_breaches(column: str, allowed: Iterable[object]) -> Column:
    """Aggregate: rows whose value is not in the list, NULL included."""
    return F.count_if(outside_domain(F.col(column), allowed))


def blank_column(df: DataFrame, column: str) -> dict[str, Gate]:
    """Gates: a column exists and nothing but blanks is in it."""
    if column not in df.columns:
        return {f"{column} exists": Gate(F.count_if(F.lit(False)), 1)}
    return {f"{column} filled": Gate(F.count_if(~is_blank(F.col(column))), 0)}
