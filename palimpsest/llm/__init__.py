"""Operators for preparing language-model training data, and their queries."""

from palimpsest.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
