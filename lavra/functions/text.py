"""Cleaning of text columns and predicates on them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented capitals and the letters they fold to, position by position.
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
UNACCENTED = "AAAAAEEEEIIIIOOOOOUUUUC"

# A C1 control character that stands for a dash in files whose
# Windows bytes are read as ISO-8859-1.
CONTROL_REPAIRS = {"\u0096": "–"}

# The C1 characters that stand for Windows-1252 bytes, and what these mean; it leaves five
# of the 32 undefined.
WINDOWS_1252_BYTES = [
    b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "replace") != "\ufffd"
]
WINDOWS_1252_CONTROLS = "".join(map(chr, WINDOWS_1252_BYTES))
WINDOWS_1252_CHARACTERS = bytes(WINDOWS_1252_BYTES).decode("cp1252")

# Fixed value: what decoders write in place of bytes they cannot decode.
REPLACEMENT_CHARACTER = "�"


def named(name: str) -> Column:
    """A column by its exact name, whatever characters a file header put in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(column: Column) -> Column:
    """NULL for the empty string, other values as they are."""
    return F.nullif(column, F.lit(""))


def clean_text(column: Column, repairs: Mapping[str, str] | None = None) -> Column:
    """Repair characters in turn, trim spaces (tabs and NBSP stay), blank to NULL."""
    for wrong, right in (repairs or {}).items():
        column = F.replace(column, F.lit(wrong), F.lit(right))
    return blank_to_null(F.trim(column))


def windows_1252(column: Column) -> Column:
    """Text of Windows-1252 that was read as ISO-8859-1, with the 27 characters put right.

    The five bytes that it does not define stay control characters. Text of ASCII only is
    passed by.
    """
    return F.when(
        F.octet_length(column) > F.length(column),
        F.translate(column, WINDOWS_1252_CONTROLS, WINDOWS_1252_CHARACTERS),
    ).otherwise(column)


def digits_only(column: Column) -> Column:
    """The ASCII digits of an identifier as text, NULL when it has none."""
    return blank_to_null(F.regexp_replace(column, "[^0-9]+", ""))


def first_integer(column: Column, strict: bool = True) -> Column:
    """The first run of digits as an int; NULL where there is none.

    A number beyond ``int`` fails under ANSI mode, as any other cast of the library does;
    otherwise it becomes NULL.
    """
    digits = F.nullif(F.regexp_extract(column, r"(\d+)", 1), F.lit(""))
    return digits.cast("int") if strict else digits.try_cast("int")


def fold_accents(column: Column) -> Column:
    """Accented capitals without their accent.

    Text of ASCII only (as many bytes as characters) has none and is passed by.
    """
    return F.when(
        F.octet_length(column) > F.length(column), F.translate(column, ACCENTED, UNACCENTED)
    ).otherwise(column)


def drop_suffix(column: Column, suffix: str) -> Column:
    """Without a literal suffix and the white space around it.

    Text that does not end in the suffix stays as it is. Trimming is linear in the
    length of a text; a pattern that ends in white space is not.
    """
    white = F.lit(" \t\n\x0b\f\r")
    trimmed = F.rtrim(column, white)
    kept = F.rtrim(F.left(trimmed, F.length(trimmed) - len(suffix)), white)
    return F.when(trimmed.endswith(suffix), kept).otherwise(column)


def squeeze_spaces(column: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(column, r"\s+", " "))


def is_blank(column: Column) -> Column:
    """True for NULL and for text of spaces only; never NULL."""
    return column.isNull() | (F.trim(column) == "")


def contains_char(column: Column, text: str) -> Column:
    """True where the text occurs; false, not NULL, for NULL input."""
    return F.coalesce(column.contains(text), F.lit(False))


def count_occurrences(column: Column, text: str) -> Column:
    """How many times a literal text occurs, without overlaps."""
    return F.regexp_count(column, F.lit(re.escape(text)))


def outside_domain(column: Column, allowed: Iterable[object]) -> Column:
    """True for values not in the list and for NULL, which ``isin`` would let pass."""
    return ~F.coalesce(column.isin(list(allowed)), F.lit(False))
