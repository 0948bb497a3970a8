"""Profiles: what a table holds, as rows of a report. One pass over the table each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.keys import KEY_WIDTH, RESERVED_KEY, with_key_details
from lavra.functions.numeric import (
    NUMBER_FORMATS,
    OTHER_FORMAT,
    is_plain_number,
    normalized_decimal,
    number_format,
)
from lavra.functions.text import REPLACEMENT_CHARACTER, blank_to_null, contains_char, named
from lavra.operators.shape import available_columns, columns_of_type


def per_column(
    df: DataFrame, columns: Sequence[str], measures: dict[str, object]
) -> DataFrame:
    """Aggregate every column by the same measures; one row per column.

    ``measures`` maps an output name to a function from a column to an aggregate.
    All are computed in a single aggregation and then laid out as rows.
    """
    aggregates = [
        measure(named(name)).alias(f"m{i}_{label}")
        for i, name in enumerate(columns)
        for label, measure in measures.items()
    ]
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            *[F.col(f"m{i}_{label}").alias(label) for label in measures],
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and NULLs per column."""
    return per_column(
        df,
        columns or df.columns,
        {"n_rows": lambda c: F.count(F.lit(1)), "n_nulls": lambda c: F.count_if(c.isNull())},
    )


def column_fill(df: DataFrame) -> DataFrame:
    """Type and number of values of each column."""
    types = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    filled = per_column(df, df.columns, {"n_values": F.count})
    labels = F.create_map(*[F.lit(part) for item in types.items() for part in item])
    return filled.select("column", labels[F.col("column")].alias("type"), "n_values")


def char_scan(
    df: DataFrame, text: str = REPLACEMENT_CHARACTER, columns: Sequence[str] | None = None
) -> DataFrame:
    """Per text column, the rows that hold a character (by default U+FFFD).

    The text is reported, never repaired: what was lost cannot be known.
    """
    chosen = columns or columns_of_type(df, "string")
    return per_column(df, chosen, {"n_rows": lambda c: F.count_if(contains_char(c, text))})


def char_rows(
    df: DataFrame,
    column: str,
    context: Sequence[str] = (),
    text: str = REPLACEMENT_CHARACTER,
) -> DataFrame:
    """Distinct values that hold the character, with those context columns that exist."""
    shown = available_columns(df, [*context, column])
    return df.filter(F.col(column).contains(text)).select(*shown).distinct()


def format_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows per number notation, and those that stay invalid once normalised."""
    text = blank_to_null(F.trim(column))
    classified = df.select(
        number_format(text).alias("number_format"), normalized_decimal(text).alias("normalized")
    )
    invalid = F.col("normalized").isNotNull() & ~is_plain_number(F.col("normalized"))
    return classified.groupBy("number_format").agg(
        F.count("*").alias("n_rows"), F.count_if(invalid).alias("n_invalid")
    )


def format_examples(
    df: DataFrame,
    column: str,
    formats: Sequence[str] = (next(iter(NUMBER_FORMATS)), OTHER_FORMAT),
    context: Sequence[str] = (),
) -> DataFrame:
    """Distinct values in some notations, what they normalise to, and context columns."""
    text = blank_to_null(F.trim(column))
    return (
        df.select(
            text.alias("original"),
            number_format(text).alias("number_format"),
            normalized_decimal(text).alias("normalized"),
            *context,
        )
        .filter(F.col("number_format").isin(list(formats)))
        .distinct()
    )


def key_length_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows per number of digits of an identifier."""
    detailed = with_key_details(df.select(column), column, "digits", "n_digits", "key")
    return detailed.groupBy("n_digits").agg(F.count("*").alias("n_rows"))


def key_exceptions(df: DataFrame, column: str, width: int = KEY_WIDTH) -> DataFrame:
    """Rows whose identifier is too long for a key, or makes the reserved key."""
    detailed = with_key_details(df.select(column), column, "digits", "n_digits", "key", width)
    return detailed.agg(
        F.count_if(F.col("n_digits") > width).alias("too_long"),
        F.count_if(F.col("key") == RESERVED_KEY).alias("reserved"),
    )


def source_profile(df: DataFrame, label: str, text: str | None = None) -> DataFrame:
    """One row on a source as read: rows, columns, names, rows that hold a text."""
    hits: Column = F.lit(0).cast("long")
    if text is not None and df.columns:
        holds = [contains_char(named(name), text) for name in df.columns]
        hits = F.count_if(F.greatest(*holds) if len(holds) > 1 else holds[0])
    return df.agg(F.count("*").alias("n_rows"), hits.alias("n_hits")).select(
        F.lit(label).alias("source"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.array(*[F.lit(name) for name in df.columns]).alias("column_names"),
        "n_hits",
    )
