"""History of slowly changing data on Spark: snapshots in, versions out."""

from palimpsest.operators.history import as_of, as_of_join, at_time, current, history_from_log
from palimpsest.operators.merge import keyed_upsert, merge_log, outcome_counts, scd2_merge
from palimpsest.plans.read import read, snapshot
from palimpsest.plans.refresh import refresh
from palimpsest.resources import RESOURCES
from palimpsest.session import session
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.spec import Field, Filter, ResourceSpec

__all__ = [
    "RESOURCES",
    "Field",
    "Filter",
    "HistoryStore",
    "KeyedStore",
    "ResourceSpec",
    "as_of",
    "as_of_join",
    "at_time",
    "current",
    "history_from_log",
    "keyed_upsert",
    "merge_log",
    "outcome_counts",
    "read",
    "refresh",
    "scd2_merge",
    "session",
    "snapshot",
]
