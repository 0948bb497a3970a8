"""Raw layer: each source as a Parquet dataset, unchanged but for the format."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lavra.operators.quality import Gate, blank_column, expect, stack_reports
from lavra.operators.quarantine import record_text
from lavra.sources.files import MALFORMED, SourceSpec, read_checked, read_delimited, read_group
from lavra.sources.sink import write_parquet, write_verified

REJECT_SCHEMA = "source string, line string, column string, text string, reason string"


def ingest(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    input_base: str,
    raw_base: str,
    at_once: int = 8,
    rejects: str | None = None,
) -> DataFrame:
    """Ingest every source; a report of rows written and rows stored, with the total.

    Up to ``at_once`` sources are submitted together, so that small ones do not
    leave a cluster waiting.

    With ``rejects`` the layout is checked on the way: the report also says how many lines of
    each source have too few or too many fields (none are expected), and those lines are
    stored in that folder (see ``read_rejects``). The raw datasets hold them all the same,
    filled or cut to the header's columns.
    """

    def ingest_one(spec: SourceSpec) -> tuple[DataFrame, int]:
        path = spec.input_path(input_base)
        if rejects is None:
            table = read_delimited(spark, path, spec.sep, spec.encoding)
            return write_verified(table, spec.raw_path(raw_base), spec.file)[1], 0
        table = read_checked(spark, path, spec.sep, spec.encoding)
        seen = Observation()
        checked = table.observe(
            seen, F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed")
        ).drop(MALFORMED)
        report = write_verified(checked, spec.raw_path(raw_base), spec.file)[1]
        malformed = seen.get["malformed"]
        # A second look at a source that has such lines; there should be none.
        bad = malformed_lines(table, spec).limit(0) if not malformed else malformed_lines(table, spec)
        write_parquet(bad, f"{rejects.rstrip('/')}/{spec.group}/{spec.target}")
        return report, malformed

    refuse_repeated([spec.file for spec in specs])
    with ThreadPoolExecutor(at_once) as pool:
        results = list(pool.map(ingest_one, specs))
    report = with_total(stack_reports([report for report, _ in results]))
    if rejects is None:
        return report
    layout = [
        (f"{spec.file}: malformed lines", n, 0, n == 0)
        for spec, (_, n) in zip(specs, results, strict=True)
    ]
    return report.unionByName(spark.createDataFrame(layout, report.schema))


def malformed_lines(table: DataFrame, spec: SourceSpec) -> DataFrame:
    """Lines of the wrong number of fields as rejects; ``text`` is what was made of them."""
    fields = [name for name in table.columns if name != MALFORMED]
    return table.filter(F.col(MALFORMED).isNotNull()).select(
        F.lit(spec.file).alias("source"),
        F.col(MALFORMED).alias("line"),
        F.lit(None).cast("string").alias("column"),
        record_text(fields, spec.sep).alias("text"),
        F.lit("layout").alias("reason"),
    )


def read_rejects(spark: SparkSession, specs: Sequence[SourceSpec], rejects: str) -> DataFrame:
    """The malformed lines of all sources that ``ingest`` stored, in a single scan."""
    paths = [f"{rejects.rstrip('/')}/{spec.group}/{spec.target}" for spec in specs]
    return spark.read.schema(REJECT_SCHEMA).parquet(*paths)


def ingest_group(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    names: Sequence[str],
    input_base: str,
    path: str,
    source_column: str,
    source: Column | None = None,
) -> DataFrame:
    """Ingest sources of one layout in one job, as one dataset partitioned by source.

    The report says whether all rows and sources were stored, whether any line had too
    few or too many fields, and whether each source has the rows its descriptor expects.
    """
    layouts = {(spec.sep, spec.encoding) for spec in specs}
    if len(layouts) != 1:
        raise ValueError(f"sources of one group must share separator and charset: {layouts}")
    ((sep, encoding),) = layouts
    paths = [spec.input_path(input_base) for spec in specs]
    table = read_group(
        spark, paths, names, sep, encoding, source_column, source, keep_malformed=True
    )
    seen = Observation()
    counted = table.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
    )
    write_parquet(counted.drop(MALFORMED), path, [source_column])
    stored = spark.read.schema(table.drop(MALFORMED).schema).parquet(path)
    gates = {
        "rows stored": Gate(F.count(F.lit(1)), seen.get["rows"]),
        "sources stored": Gate(F.count_distinct(source_column), len(specs)),
        "malformed lines": Gate(F.max(F.lit(seen.get["malformed"])), 0),
    }
    wanted = [
        (spec.file, spec.expected_rows) for spec in specs if spec.expected_rows is not None
    ]
    report = expect(stored, gates)
    if not wanted:
        return report
    # Thousands of sources are rows of a table, not columns of one aggregation.
    expected = spark.createDataFrame(wanted, "source string, expected long")
    counts = stored.groupBy(F.col(source_column).alias("source")).agg(
        F.count(F.lit(1)).alias("actual")
    )
    per_source = expected.join(counts, "source", "left").select(
        F.concat("source", F.lit(": rows")).alias("check"),
        F.coalesce("actual", F.lit(0)).alias("actual"),
        "expected",
        F.equal_null(F.coalesce("actual", F.lit(0)), "expected").alias("ok"),
    )
    return report.unionByName(per_source)


def validate_raw(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    raw_base: str,
    blank_in: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of each raw dataset (``group/target``) against the rows expected, and in total.

    ``blank_in`` names, per group, a column that must exist and be blank. A source without
    an expectation is counted and not checked, and then neither is the total.
    """
    refuse_repeated([f"{spec.group}/{spec.target}" for spec in specs])
    counts, blanks = [], []
    for spec in specs:
        label = f"{spec.group}/{spec.target}"
        table = spark.read.parquet(spec.raw_path(raw_base))
        rows = Gate(F.count(F.lit(1)), spec.expected_rows)
        counts.append(expect(table, {label: rows}))
        if blank_in and spec.group in blank_in:
            gates = blank_column(table, blank_in[spec.group])
            blanks.append(expect(table, {f"{label}: {k}": g for k, g in gates.items()}))
    return stack_reports([with_total(stack_reports(counts)), *blanks])


def refuse_repeated(labels: Sequence[str]) -> None:
    """Rows of a report are told apart by their label, so no two may share one."""
    repeated = sorted({label for label in labels if labels.count(label) > 1})
    if repeated:
        raise ValueError(f"more than one source is called {', '.join(repeated)}")


def with_total(report: DataFrame, label: str = "total") -> DataFrame:
    """A report of counts and, from the same pass, one more row for their sums.

    Labels must differ. The total is checked if every row is.
    """
    summed = report.rollup("check").agg(
        F.sum("actual").alias("actual"),
        F.when(F.count("expected") == F.count(F.lit(1)), F.sum("expected")).alias("expected"),
        F.grouping("check").alias("of_all"),
    )
    return summed.select(
        F.when(F.col("of_all") == 1, F.lit(label)).otherwise(F.col("check")).alias("check"),
        "actual",
        "expected",
        F.when(F.col("expected").isNotNull(), F.equal_null("actual", "expected")).alias("ok"),
    )
