"""Numbers held in text: which notation they use, and their value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notation classes in the order they are tried.
NULL_FORMAT = "NULO"
NUMBER_FORMATS = {
    "MILHAR_PONTO_DECIMAL_VIRGULA": r"^-?\d{1,3}(\.\d{3})+,\d+$",
    "DECIMAL_VIRGULA": r"^-?\d+,\d+$",
    "DECIMAL_PONTO": r"^-?\d+\.\d+$",
    "INTEIRO": r"^-?\d+$",
}
OTHER_FORMAT = "OUTRO_FORMATO"
PLAIN_NUMBER = r"^-?\d+(\.\d+)?$"


def number_format(column: Column) -> Column:
    """Name of the first notation class the text belongs to."""
    return reduce(
        lambda chain, item: chain.when(column.rlike(item[1]), item[0]),
        NUMBER_FORMATS.items(),
        F.when(column.isNull(), NULL_FORMAT),
    ).otherwise(OTHER_FORMAT)


def normalized_decimal(column: Column) -> Column:
    """Comma-decimal text with a point for the comma and no grouping points.

    Text without a comma is left alone, so ``1.234`` stays what it is.
    """
    return F.when(column.contains(","), F.translate(column, ",.", ".")).otherwise(column)


def parse_decimal(column: Column, strict: bool = True) -> Column:
    """Value of a decimal in either notation.

    Strict parsing fails on text that is no number (in ANSI mode); otherwise
    such text becomes NULL and ``is_plain_number`` finds it.
    """
    text = normalized_decimal(column)
    return text.cast("double") if strict else text.try_cast("double")


def is_plain_number(column: Column) -> Column:
    """Whether normalised text is an optionally signed, optionally decimal number."""
    return column.rlike(PLAIN_NUMBER)


def percent(part: Column, whole: Column) -> Column:
    """Share in per cent, 0.0 of an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
