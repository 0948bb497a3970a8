"""Operators for training data. Nothing else in the library imports this package."""

from lavra.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
