"""Rows that fail a cast or a layout, kept apart from the good ones.

A strict cast ends a job at the first bad cell, a lenient one turns it into NULL. Here each
row is looked at once: the job that types a table also notes, per row, which cells failed and
why, and both parts are read from what it wrote. Rows without a failure are the good ones; a
row with several bad cells makes as many rejects but is one rejected row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lavra.functions.text import named
from lavra.operators.quality import Gate
from lavra.session import scratch_path

REJECTS = "_rejects"
REJECTED = "_rejected"
SOURCE = "_source"
LINE = "_line"

REJECT_COLUMNS = ["source", "line", "column", "text", "reason"]


@dataclass(frozen=True)
class Cell:
    """A column of the result: its value, and when the text it comes from is unfit.

    ``value`` must be NULL, not an error, where ``fails`` is true. ``text`` is what a reject
    shows.
    """

    value: Column
    text: Column | None = None
    fails: Column | None = None
    reason: str = ""


def cast_cell(text: Column, value: Column, reason: str) -> Cell:
    """A cell that fails where there is text and no value comes of it."""
    return Cell(value, text, text.isNotNull() & value.isNull(), reason)


@dataclass(frozen=True)
class Quarantine:
    """Both parts of a table, as stored, and how many rows went into each."""

    good: DataFrame
    rejects: DataFrame
    rows: int
    rejected_rows: int
    rejected_cells: int
    path: str

    def gates(
        self, raw_rows: int, label: str, rejected: int | None = None
    ) -> dict[str, Gate]:
        """Every raw row is either good or rejected; for a report on the good rows.

        The number of rejected rows is checked if one is given.
        """
        return {
            f"{label}: good and rejected rows": Gate(
                F.count(F.lit(1)) + self.rejected_rows, raw_rows
            ),
            f"{label}: rejected rows": Gate(_constant(self.rejected_rows), rejected),
        }


def _constant(value: int) -> Column:
    return F.count(F.lit(1)) * 0 + value


def typed_cells(df: DataFrame, types: Mapping[str, Sequence[str]]) -> dict[str, Column | Cell]:
    """Cells of a table whose columns listed under a type name are cast to it."""
    target = {name: type_name for type_name, names in types.items() for name in names}
    return {
        name: cast_cell(named(name), named(name).try_cast(target[name]), f"no {target[name]}")
        if name in target
        else named(name)
        for name in df.columns
    }


def record_text(columns: Sequence[str], separator: str) -> Column:
    """The fields of a row as one line of text; NULL is an empty field."""
    return F.concat_ws(separator, *[F.coalesce(named(name), F.lit("")) for name in columns])


def quarantine(
    df: DataFrame,
    cells: Mapping[str, Column | Cell],
    source: Column,
    line: Column,
    path: str | None = None,
    layout: Column | None = None,
) -> Quarantine:
    """Type a table and set the rows apart of which a cell is unfit, in one job.

    ``cells`` gives the columns of the result. ``source`` and ``line`` say in the rejects
    where a row came from. ``layout`` is text that is not NULL where the whole line is unfit
    (such as one of too many fields). Rejects are few columns of few rows: reading them skips
    the parts of the files that hold none. Both parts lie in the shared folder unless
    ``path`` names another.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "quarantine")
    typed = {n: c if isinstance(c, Cell) else Cell(c) for n, c in cells.items()}
    failures = [
        F.when(
            cell.fails,
            F.struct(
                F.lit(name).alias("column"),
                cell.text.cast("string").alias("text"),
                F.lit(cell.reason).alias("reason"),
            ),
        )
        for name, cell in typed.items()
        if cell.fails is not None
    ]
    if layout is not None:
        failures.append(
            F.when(
                layout.isNotNull(),
                F.struct(
                    F.lit(None).cast("string").alias("column"),
                    layout.alias("text"),
                    F.lit("layout").alias("reason"),
                ),
            )
        )
    none = F.array().cast("array<struct<column:string,text:string,reason:string>>")
    failed = F.array_compact(F.array(*failures)) if failures else none
    checked = df.select(
        *[cell.value.alias(name) for name, cell in typed.items()],
        F.when(F.size(failed) > 0, failed).alias(REJECTS),
        source.alias(SOURCE),
        line.alias(LINE),
    )
    rejected = F.col(REJECTS).isNotNull()
    checked = checked.withColumns(
        {
            REJECTED: rejected,
            # What only rejects show is not stored for the others.
            SOURCE: F.when(rejected, F.col(SOURCE)),
            LINE: F.when(rejected, F.col(LINE)),
        }
    )
    seen = Observation()
    checked.observe(
        seen,
        F.count_if(~F.col(REJECTED)).alias("rows"),
        F.count_if(F.col(REJECTED)).alias("rejected"),
        F.coalesce(F.sum(F.size(REJECTS)), F.lit(0)).alias("cells"),
    ).write.mode("overwrite").parquet(path)
    counts = seen.get
    stored = spark.read.schema(checked.schema).parquet(path)
    good = stored.filter(~F.col(REJECTED)).select(*[named(name) for name in typed])
    rejects = (
        stored.filter(F.col(REJECTED))
        .select(F.col(SOURCE).alias("source"), F.col(LINE).alias("line"), F.explode(REJECTS))
        .select("source", "line", "col.column", "col.text", "col.reason")
    )
    return Quarantine(
        good, rejects, counts["rows"], counts["rejected"], counts["cells"], path
    )
