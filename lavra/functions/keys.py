"""Keys that two datasets can be joined on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import digits_only, drop_suffix, fold_accents, squeeze_spaces

# Fixed values.
KEY_WIDTH = 8
RESERVED_KEY = "00000000"
GROUP_SUFFIX = "(CONGLOMERADO)"
DEMOTED_MARKER = "PRUDENCIAL"


def fixed_width_key(column: Column, width: int = KEY_WIDTH) -> Column:
    """Digits padded with zeros on the left.

    NULL when there are no digits or more than ``width``: cutting a longer
    identifier would make it equal to another one.
    """
    digits = F.regexp_replace(column, "[^0-9]+", "")
    return F.when(F.length(digits).between(1, width), F.lpad(digits, width, "0"))


def is_usable_key(key: Column, reserved: str = RESERVED_KEY) -> Column:
    """Neither NULL nor the reserved key."""
    return key.isNotNull() & (key != reserved)


def strong_name_key(column: Column, suffix: str = GROUP_SUFFIX) -> Column:
    """Name reduced to unaccented capitals, digits and single spaces.

    Characters outside the folding table (a replacement character, say) turn
    into a space; a name of punctuation only gives the empty string.
    """
    name = drop_suffix(F.upper(F.trim(column)), suffix)
    return F.trim(F.regexp_replace(fold_accents(name), "[^A-Z0-9]+", " "))


def weak_name_key(column: Column) -> Column:
    """Name in capitals with single spaces; accents and punctuation stay."""
    return F.upper(squeeze_spaces(column))


def segment_key(column: Column) -> Column:
    """Trimmed capitals."""
    return F.upper(F.trim(column))


def priority_rank(column: Column, marker: str = DEMOTED_MARKER) -> Column:
    """2 for names that hold the marker in any case, 1 for others and for NULL."""
    return F.when(F.upper(column).contains(marker), 2).otherwise(1)


def with_key_details(
    df: DataFrame,
    column: str,
    digits: str = "cnpj_digitos",
    size: str = "cnpj_tamanho",
    key: str = "cnpj_chave_8",
    width: int = KEY_WIDTH,
) -> DataFrame:
    """Add the digits, their number and the fixed-width key of an identifier."""
    only_digits = digits_only(F.col(column))
    return df.withColumns(
        {
            digits: only_digits,
            size: F.length(only_digits),
            key: fixed_width_key(F.col(column), width),
        }
    )
