"""Queries that run the operators on the test tables, each with its SQL counterpart."""

from lavra.bindings import (  # noqa: F401  (each module registers its queries)
    aggregates,
    enrichment,
    files,
    keys,
    layers,
    quality,
    rejects,
    text,
)
from lavra.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
