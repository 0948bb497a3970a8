"""Many text sources looked at in one scan: layout, charset, damage.

Lines are read as bytes. A table of readings (which file, under which separator and charset)
is joined to them by the file they come from, and everything is counted per reading, so
thousands of sources of different layouts are one plan and one job, and one source under
several charsets is read once.

What a line holds follows Spark's own reader of delimited text: blank lines are passed over,
the first line of a file is its header, a field in quotes may hold the separator. Fields that
hold a line break are not put together here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import REPLACEMENT_CHARACTER, contains_char, windows_1252

UTF_8, LATIN_1, WINDOWS_1252 = "UTF-8", "ISO-8859-1", "windows-1252"
CHARSETS = (UTF_8, LATIN_1, WINDOWS_1252)

# Bytes as the characters of ISO-8859-1: sequences of UTF-8, the C1 range (characters in
# Windows-1252, controls in ISO-8859-1), and those that Windows-1252 does not define.
SEQUENCE = "[Â-ß][\u0080-¿]|[à-ï][\u0080-¿]{2}|[ð-ô][\u0080-¿]{3}"
HIGH = "[\u0080-ÿ]"
C1 = "[\u0080-\u009f]"
UNDEFINED = "[\u0081\u008d\u008f\u0090\u009d]"


@dataclass(frozen=True)
class Reading:
    """A file or folder and how it is to be read."""

    source: str
    path: str
    sep: str
    charset: str = UTF_8


def known_charset(name: str) -> str:
    """One of the charsets a survey can read, whatever its spelling."""
    plain = name.upper().replace("_", "-")
    names = {
        "UTF-8": UTF_8, "UTF8": UTF_8, "ISO-8859-1": LATIN_1, "LATIN1": LATIN_1, "LATIN-1": LATIN_1,
        "WINDOWS-1252": WINDOWS_1252, "CP1252": WINDOWS_1252,
    }
    if plain not in names:
        raise ValueError(f"{name} is none of {', '.join(CHARSETS)}")
    return names[plain]


def one_slash(uri: Column) -> Column:
    """Local files are listed as file:///x and scanned as file:/x."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def _files_of(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """(file, path it was found under); a listing, no file is opened."""
    new_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    by_uri: dict[str, str] = {}
    for path in dict.fromkeys(paths):
        located = new_path(path)
        by_uri[_plain(located.getFileSystem(conf).makeQualified(located).toUri().toString())] = path
    found = []
    for uri in spark.read.text(list(by_uri.values())).inputFiles():
        at = uri = _plain(uri)
        while at not in by_uri and "/" in at:
            at = at.rpartition("/")[0]
        found.append((uri, by_uri[at]))
    return found


def _plain(uri: str) -> str:
    scheme, colon, rest = uri.partition(":")
    return f"file:/{rest.lstrip('/')}" if scheme == "file" and colon else uri


def raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Physical lines of all files: uri, at (their order within a file), raw (text whose
    bytes are those of the file)."""
    return spark.read.text(list(dict.fromkeys(paths))).select(
        one_slash(F.col("_metadata.file_path")).alias("uri"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("at"),
        F.col("value").alias("raw"),
    )


def decoded(raw: Column, charset: Column) -> Column:
    """Text of a line under the charset of its reading; what is no UTF-8 becomes U+FFFD."""
    latin = F.decode(raw.cast("binary"), LATIN_1)
    return (
        F.when(charset == UTF_8, F.make_valid_utf8(raw))
        .when(charset == WINDOWS_1252, windows_1252(latin))
        .otherwise(latin)
    )


def fields(text: Column, sep: Column) -> Column:
    """The fields of a line; separators between quotes do not count."""
    literal = F.concat(F.lit("\\Q"), sep, F.lit("\\E"))
    outside = F.concat(literal, F.lit('(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    return F.split(text, F.when(text.contains('"'), outside).otherwise(literal), -1)


def header_names(names: Column) -> Column:
    """Names as Spark gives them: ``_c`` and the place for a blank one, and the place after
    one that occurs twice, in any case."""
    plain = F.transform(names, lambda n: F.regexp_replace(n, '^"(.*)"$', "$1"))
    lowered = F.transform(plain, lambda n: F.lower(n))
    return F.transform(
        plain,
        lambda n, i: F.when(F.trim(n) == "", F.concat(F.lit("_c"), i.cast("string")))
        .when(
            F.size(F.filter(lowered, lambda other: other == F.lower(n))) > 1,
            F.concat(n, i.cast("string")),
        )
        .otherwise(n),
    )


def survey(spark: SparkSession, readings: Sequence[Reading]) -> DataFrame:
    """One row per reading: source, charset, n_files, n_lines, n_rows, n_columns,
    column_names, n_hits (rows that hold U+FFFD), n_malformed (lines of too few or too many
    fields), and best: whether the charset is the one that fits the bytes (see
    ``best_charset``).

    A folder is one source; its names are those of its first file, and every file has a header.
    """
    labels = [(r.source, r.charset) for r in readings]
    if len(set(labels)) < len(labels):
        raise ValueError("two readings share source and charset")
    by_path: dict[str, list[tuple[str, Reading]]] = {}
    for reading in readings:
        by_path.setdefault(reading.path, []).append((known_charset(reading.charset), reading))
    listed = _files_of(spark, list(by_path))
    rows = [
        (uri, r.source, r.charset, charset, r.sep)
        for uri, path in listed
        for charset, r in by_path[path]
    ]
    table = spark.createDataFrame(
        rows, "uri string, source string, charset string, _charset string, sep string"
    )
    lines = raw_lines(spark, list(by_path)).filter(F.trim("raw") != "")
    classes = [
        F.sum(value.cast("long")).alias(name) for name, value in byte_classes(F.col("raw")).items()
    ]
    # The readings are a list of the caller, a row per file and charset.
    read = lines.join(F.broadcast(table), "uri").withColumn(
        "text", decoded(F.col("raw"), F.col("_charset"))
    )
    key = ["uri", "source", "charset", "sep", "_charset"]
    # Spark sorts all lines by group for aggregates of text alone. With a set among them, here
    # of the few blocks of a file, it keeps one first line per group instead.
    by_width = (
        read.withColumn("width", F.size(fields(F.col("text"), F.col("sep"))))
        .groupBy(*key, "width")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.collect_set("at.block").alias("blocks"),
            F.min("at").alias("at"),
            F.min_by("text", "at").alias("first"),
            F.count_if(contains_char(F.col("text"), REPLACEMENT_CHARACTER)).alias("hits"),
            *classes,
        )
        .withColumn("at", F.struct(F.array_min("blocks"), "at.line"))
    )
    names = list(byte_classes(F.col("raw")))
    per_file = (
        by_width.groupBy(*key)
        .agg(
            F.sum("n").alias("n"),
            F.min_by("first", "at").alias("header"),
            F.min_by("width", "at").alias("width"),
            F.map_from_entries(F.collect_list(F.struct("width", "n"))).alias("widths"),
            F.sum("hits").alias("hits"),
            *[F.sum(name).alias(name) for name in names],
        )
        .withColumn("fitting", F.col("widths")[F.col("width")])
    )
    in_header = contains_char(F.col("header"), REPLACEMENT_CHARACTER).cast("long")
    per_reading = per_file.groupBy("source", "charset", "_charset").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n").alias("n_lines"),
        F.sum(F.col("n") - 1).alias("n_rows"),
        F.min_by("width", "uri").alias("n_columns"),
        F.min_by(header_names(fields(F.col("header"), F.col("sep"))), "uri").alias("column_names"),
        F.sum(F.col("hits") - in_header).alias("n_hits"),
        F.sum(F.col("n") - F.col("fitting")).alias("n_malformed"),
        *[F.sum(name).alias(name) for name in names],
    )
    best = best_charset(*[F.col(name) for name in names])
    found = per_reading.withColumn("best", F.col("_charset") == best)
    # Sources without a line that is not blank are rows too.
    wanted = spark.createDataFrame(labels, "source string, charset string")
    nothing = {n: 0 for n in ("n_files", "n_lines", "n_rows", "n_columns", "n_hits", "n_malformed")}
    return (
        wanted.join(found.drop("_charset", *names), ["source", "charset"], "left")
        .na.fill(nothing)
        .withColumn("column_names", F.coalesce("column_names", F.array().cast("array<string>")))
    )


def byte_classes(raw: Column) -> dict[str, Column]:
    """Per line: bytes above ASCII that are in no sequence of UTF-8, bytes of the C1 range
    (whether in one or not), and bytes that Windows-1252 does not define."""
    latin = F.decode(raw.cast("binary"), LATIN_1)
    plain = F.octet_length(latin) == F.octet_length(raw)  # ASCII only

    def count(text: Column, pattern: str) -> Column:
        return F.when(plain, 0).otherwise(F.regexp_count(text, F.lit(pattern)))

    return {
        "n_no_utf8": count(F.regexp_replace(latin, SEQUENCE, ""), HIGH),
        "n_c1": count(latin, C1),
        "n_undefined": count(latin, UNDEFINED),
    }


def best_charset(no_utf8: Column, c1: Column, undefined: Column) -> Column:
    """The charset that fits best: UTF-8 if all bytes above ASCII are its sequences (text of
    another charset is that only by rare chance); else ISO-8859-1 if there are no bytes of the
    C1 range, which are never meant as controls; else Windows-1252 if it defines all of them."""
    return (
        F.when(no_utf8 == 0, UTF_8)
        .when(c1 == 0, LATIN_1)
        .when(undefined == 0, WINDOWS_1252)
        .otherwise(LATIN_1)
    )
