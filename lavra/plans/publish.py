"""Publishing a finished table to Parquet and to a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.quality import Gate, expect, stack_reports
from lavra.operators.shape import schema_diff
from lavra.sources.jdbc import JdbcTarget, count_jdbc, read_jdbc, write_jdbc
from lavra.sources.sink import WriteResult
from lavra.sources.versions import VersionedTable

PROBE_TEXT = "written and read back"


def name_gates(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """Report: column names one of two tables lacks (types may differ between stores)."""
    differing = schema_diff(left, right)
    return expect(
        differing,
        {
            f"{label}: columns missing": Gate(F.count_if(F.col("status") == "missing"), 0),
            f"{label}: columns extra": Gate(F.count_if(F.col("status") == "extra"), 0),
        },
    )


def jdbc_round_trip(spark: SparkSession, target: JdbcTarget) -> DataFrame:
    """Report: one literal row, written to a table and read back with its content."""
    probe = spark.createDataFrame([(1, PROBE_TEXT)], "id long, status string")
    write_jdbc(probe, target, connections=1)
    stored = read_jdbc(spark, target)
    return expect(
        stored,
        {
            f"{target.table}: rows": Gate(F.count(F.lit(1)), 1),
            f"{target.table}: rows as written": Gate(F.count_if(F.col("status") == PROBE_TEXT), 1),
        },
    )


def publish_table(df: DataFrame, rows: int, target: JdbcTarget, **write_options) -> DataFrame:
    """Replace a relational table and compare rows and column names with the source.

    ``rows`` is the count taken when the source was written.
    """
    write_jdbc(df, target, **write_options)
    return published_gates(df, rows, target)


def published_gates(df: DataFrame, rows: int, target: JdbcTarget) -> DataFrame:
    """Report: rows and column names of a relational table against its source."""
    spark = df.sparkSession
    counted = expect(
        count_jdbc(spark, target), {f"{target.table}: rows": Gate(F.max("n_rows"), rows)}
    )
    return stack_reports([counted, name_gates(df, read_jdbc(spark, target), target.table)])


def materialize_final(
    delivery: DataFrame,
    path: str,
    target: JdbcTarget | None = None,
    gates: dict[str, Gate] | None = None,
    **write_options,
) -> tuple[WriteResult, DataFrame]:
    """Final table as Parquet, and from there as a relational table; with a report.

    The new version is written beside the old one and read back: rows, content, column names
    and the ``gates`` given are checked before it is published (see ``VersionedTable``). If a
    check fails, the old version stays current, the relational table is not touched and the
    report says why. The relational table is replaced after that.
    """
    table = VersionedTable(delivery.sparkSession, path)
    version, result, report = table.write(delivery, "final table", content=True)
    final = result.read(delivery.sparkSession)
    reports = [report, name_gates(delivery, final, "final table")]
    if gates:
        reports.append(expect(final, gates))
    report = worked_out(stack_reports(reports))
    if not report.filter(~F.col("ok")).isEmpty():
        return result, report
    table.publish(version)
    if target is not None:
        report = report.unionByName(publish_table(final, result.rows, target, **write_options))
    return result, report


def worked_out(report: DataFrame) -> DataFrame:
    """A report (one row per check) as plain rows, so that its checks run once."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
