"""Operators on whole tables."""

from lavra.operators.aggregate import (
    distinct_counts,
    group_counts,
    key_coverage,
    row_coverage,
)
from lavra.operators.canonical import (
    canonical,
    canonical_check,
    duplicate_keys,
    duplicate_rows,
    duplicate_summary,
)
from lavra.operators.checksum import (
    content_gate,
    content_gates,
    content_sum,
    portable_sum,
    row_hash,
    same_content,
)
from lavra.operators.join import (
    Reference,
    enrich_left,
    flag_matches,
    matched_keys,
    measure_keys,
    measure_reference,
    measure_references,
    split_by_null,
    unmatched_keys,
    unmatched_rows,
)
from lavra.operators.profile import (
    char_rows,
    char_scan,
    column_fill,
    format_examples,
    format_profile,
    key_exceptions,
    key_length_profile,
    null_profile,
    source_profile,
)
from lavra.operators.quality import (
    Gate,
    QualityError,
    blank_column,
    compare_metrics,
    domain_breaches,
    enforce,
    expect,
    metrics,
    stack_reports,
)
from lavra.operators.quarantine import Cell, Quarantine, cast_cell, quarantine, record_text, typed_cells
from lavra.operators.shape import (
    available_columns,
    cast_columns,
    cast_rejects,
    columns_of_type,
    map_columns,
    preview,
    rename_by_position,
    schema_diff,
    union_filled,
    union_strict,
    with_source,
)

__all__ = [name for name in dir() if not name.startswith("_")]
