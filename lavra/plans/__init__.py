"""Whole jobs: ingest, trusted tables, delivery, publishing, validation."""

from lavra.plans.delivery import (
    NAME_KEY,
    TAX_KEY,
    canonical_reviews,
    canonical_segments,
    deliver,
    deliver_by_branch,
    deliver_in_one_shuffle,
    delivery_gates,
    delivery_metrics,
    unique_keys,
)
from lavra.plans.ingest import ingest, ingest_group, read_rejects, validate_raw
from lavra.plans.profiles import (
    index_profile,
    inspect_charsets,
    inspect_lines,
    inspect_structure,
    join_keys_profile,
    join_trial,
    replacement_profile,
    replacement_rows,
    strategy_profile,
)
from lavra.plans.publish import jdbc_round_trip, materialize_final, publish_table
from lavra.plans.trusted import (
    complaint_gates,
    quarantined_complaints,
    quarantined_reviews,
    read_complaint_slices,
    segment_profile,
    trusted_complaints,
    trusted_reviews,
    trusted_segments,
)
from lavra.plans.validate import Totals, totals_from, validate_layers

__all__ = [name for name in dir() if not name.startswith("_")]
