"""Column functions. All are built from Spark's own expressions; there are no UDFs."""

from lavra.functions.files import file_name, folder_name
from lavra.functions.keys import (
    fixed_width_key,
    is_usable_key,
    priority_rank,
    segment_key,
    strong_name_key,
    weak_name_key,
    with_key_details,
)
from lavra.functions.numeric import (
    is_plain_number,
    normalized_decimal,
    number_format,
    parse_decimal,
    percent,
)
from lavra.functions.text import (
    blank_to_null,
    clean_text,
    contains_char,
    count_occurrences,
    digits_only,
    drop_suffix,
    first_integer,
    fold_accents,
    is_blank,
    named,
    outside_domain,
    squeeze_spaces,
)

__all__ = [
    "blank_to_null",
    "clean_text",
    "contains_char",
    "count_occurrences",
    "digits_only",
    "drop_suffix",
    "file_name",
    "first_integer",
    "fixed_width_key",
    "fold_accents",
    "folder_name",
    "is_blank",
    "is_plain_number",
    "is_usable_key",
    "named",
    "normalized_decimal",
    "number_format",
    "outside_domain",
    "parse_decimal",
    "percent",
    "priority_rank",
    "segment_key",
    "squeeze_spaces",
    "strong_name_key",
    "weak_name_key",
    "with_key_details",
]
