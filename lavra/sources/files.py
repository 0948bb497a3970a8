"""Text files: delimited with a charset per source, or line by line."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.files import file_name
from lavra.functions.text import (
    WINDOWS_1252_CHARACTERS,
    WINDOWS_1252_CONTROLS,
    count_occurrences,
    named,
    windows_1252,
)
from lavra.sources.survey import CHARSETS, LATIN_1, Reading, survey

MALFORMED = "_malformed"


@dataclass(frozen=True)
class SourceSpec:
    """A delimited input: its file, where its raw dataset goes, how to read it."""

    file: str
    group: str
    target: str
    sep: str
    encoding: str = "UTF-8"
    expected_rows: int | None = None

    def input_path(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.file}"

    def raw_path(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.group}/{self.target}"


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str,
    encoding: str = "UTF-8",
    header: bool = True,
) -> DataFrame:
    """Every column as text under the name in the header; nothing is inferred.

    Short lines are filled with NULL and surplus fields are dropped. The charset
    must be one Spark accepts, or Windows-1252, which is read as ISO-8859-1 and put right.
    """
    table = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("encoding", _spark_charset(encoding))
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )
    return _put_right(table, encoding)


def _spark_charset(encoding: str) -> str:
    return LATIN_1 if _is_windows(encoding) else encoding


def _is_windows(encoding: str) -> bool:
    return encoding.upper().replace("_", "-") in ("WINDOWS-1252", "CP1252")


def _put_right(table: DataFrame, encoding: str) -> DataFrame:
    """Cells and names of a table of Windows-1252 that was read as ISO-8859-1."""
    if not _is_windows(encoding):
        return table
    repair = str.maketrans(WINDOWS_1252_CONTROLS, WINDOWS_1252_CHARACTERS)
    return table.select(
        *[windows_1252(named(n)).alias(n.translate(repair)) for n in table.columns]
    )


def read_checked(
    spark: SparkSession, path: str, sep: str, encoding: str = "UTF-8"
) -> DataFrame:
    """As ``read_delimited``, with a column ``_malformed``: the text of lines that have too
    few or too many fields, else NULL. Only the header is read to plan it."""
    names = read_delimited(spark, path, sep, encoding).columns
    return read_group(spark, [path], names, sep, encoding, keep_malformed=True)


def read_group(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    sep: str,
    encoding: str = "UTF-8",
    source_column: str | None = None,
    source: Column | None = None,
    keep_malformed: bool = False,
) -> DataFrame:
    """Many files of one layout in a single scan, columns named by position.

    With the names given Spark opens no file to plan the scan, so this serves a
    folder of many files. ``source_column`` adds where a row came from: its file's
    name, or the expression ``source``. ``keep_malformed`` adds a column with the text of lines
    that have too few or too many fields (else NULL), to be gated on.
    """
    fields = [*names, MALFORMED] if keep_malformed else list(names)
    reader = (
        spark.read.schema(", ".join(f"`{name}` string" for name in fields))
        .option("header", True)
        .option("sep", sep)
        .option("encoding", _spark_charset(encoding))
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
    )
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    df = reader.csv(list(paths))
    located = [(file_name() if source is None else source).alias(source_column)] if source_column else []
    cells = [named(name) for name in fields]
    if _is_windows(encoding):
        cells = [windows_1252(cell).alias(name) for cell, name in zip(cells, fields, strict=True)]
    return df.select(*cells, *located)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str,
    encoding: str = "UTF-8",
    partition_by: Sequence[str] = (),
) -> None:
    """Delimited text files with a header."""
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    writer = writer.option("encoding", encoding).option("emptyValue", "")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], schema: object | None = None
) -> DataFrame:
    """One or more Parquet datasets of one schema as one table (a single scan)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8"
) -> DataFrame:
    """Physical lines: the file's name and one text column, ``value``.

    Read as ISO-8859-1, each byte is one character, so byte patterns can be counted.
    """
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        # The text reader keeps the bytes of a line as they are in the file.
        value = F.decode(value.cast("binary"), _spark_charset(encoding))
    if _is_windows(encoding):
        value = windows_1252(value)
    return spark.read.text(paths).select(
        file_name().alias("file"), value.alias("value")
    )


def line_counts(lines: DataFrame) -> DataFrame:
    """Lines per file."""
    return lines.groupBy("file").agg(F.count("*").alias("n_lines"))


def line_occurrences(lines: DataFrame, text: str) -> DataFrame:
    """Per file: lines that hold a text, and how many times it occurs in all."""
    times = count_occurrences(F.col("value"), text)
    return lines.groupBy("file").agg(
        F.count_if(times > 0).alias("n_lines"), F.sum(times.cast("long")).alias("n_occurrences")
    )


def first_lines(spark: SparkSession, path: str, rows: int = 3) -> DataFrame:
    """The first lines of one file; Spark reads no further than it must."""
    return read_lines(spark, path).limit(rows)


PROBED = ["source", "n_rows", "n_columns", "column_names", "n_hits"]


def structure_probe(
    spark: SparkSession, specs: Sequence[SourceSpec], input_base: str
) -> DataFrame:
    """One row per source as it would be ingested: rows, columns, names, U+FFFD rows.

    All sources are read in one scan (see ``survey``)."""
    readings = [
        Reading(spec.file, spec.input_path(input_base), spec.sep, spec.encoding) for spec in specs
    ]
    return survey(spark, readings).select(*PROBED)


def charset_probe(
    spark: SparkSession, path: str, sep: str, charsets: Sequence[str]
) -> DataFrame:
    """The same input under several charsets, one row each, to compare; read once."""
    found = detect_charset(spark, path, sep, charsets)
    return found.select(F.col("charset").alias("source"), *PROBED[1:])


def detect_charset(
    spark: SparkSession, path: str, sep: str, charsets: Sequence[str] = CHARSETS
) -> DataFrame:
    """As ``charset_probe``, with the column ``best``: which charset the bytes speak for."""
    return survey(spark, [Reading(path, path, sep, charset) for charset in charsets]).select(
        "charset", *PROBED[1:], "n_malformed", "best"
    )
