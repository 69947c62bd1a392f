"""Runnable examples of every operator on the shared tables, each with the SQL that gives the
same rows where there is one."""

from palimpsest.suite.registry import ORACLE, QUERIES
from palimpsest.suite import (  # noqa: F401  (each module registers its queries)
    converting,
    counting,
    evolving,
    filtering,
    joining,
    keeping,
    landing,
    merging,
    ranging,
    reading,
    storing,
    versions,
)

__all__ = ["ORACLE", "QUERIES"]
