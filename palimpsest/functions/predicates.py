"""Row predicates of the history reads.

Text matches have two modes: "literal" takes the needle as it is, "pattern" lets `%` and
`_` in it act as wildcards. Set and prefix predicates have two readings of a NULL column: as
empty (the default), or as unknown, which keeps a row out of include and exclude alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The model prefix of each product type that has one.
MODEL_PREFIX = {"appliance": "MX", "switch": "MS", "wireless": "MR"}


def _all_rows() -> Column:
    return F.lit(True)


def _lit_array(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(i) for i in items]).cast("array<string>")


def equals(col: Column, value) -> Column:
    """Equality; an empty or absent value means no filter."""
    return col == F.lit(value) if value else _all_rows()


def equals_value(col: Column, value) -> Column:
    """Equality where 0 and False are values; only None means no filter."""
    return col == F.lit(value) if value is not None else _all_rows()


def text(col: Column, needle: str | None, match: str = "literal", strip: bool = False) -> Column:
    """Case-insensitive substring."""
    if not needle:
        return _all_rows()
    if strip:
        col, needle = F.trim(col), needle.strip()
    if match == "literal":
        return F.contains(F.lower(col), F.lower(F.lit(needle)))
    if match == "pattern":
        return col.ilike(f"%{needle}%")
    raise ValueError(f"unknown match mode {match!r}")


def has_all(col: Column, items: Sequence[str] | None, null_as_empty: bool = True) -> Column:
    if not items:
        return _all_rows()
    have = F.coalesce(col, _lit_array(())) if null_as_empty else col
    return F.size(F.array_except(_lit_array(items), have)) == 0


def has_none(col: Column, items: Sequence[str] | None, null_as_empty: bool = True) -> Column:
    if not items:
        return _all_rows()
    have = F.coalesce(col, _lit_array(())) if null_as_empty else col
    # A NULL element must not make the answer unknown.
    return ~F.arrays_overlap(F.array_compact(have), _lit_array(items))


def tags(
    col: Column,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    null_as_empty: bool = True,
) -> Column:
    """The array holds every item of `include` and none of `exclude`."""
    return has_all(col, include, null_as_empty) & has_none(col, exclude, null_as_empty)


def _prefixes(kinds: Sequence[str] | None, prefixes: dict[str, str]) -> list[str]:
    return [prefixes[k] for k in kinds or () if k in prefixes]


def prefix_any(
    col: Column, kinds: Sequence[str] | None, prefixes: dict[str, str] = MODEL_PREFIX
) -> Column:
    """The value starts with the prefix of one of `kinds`; unknown kinds do not count."""
    known = _prefixes(kinds, prefixes)
    if not known:
        return _all_rows()
    return reduce(lambda a, b: a | b, [F.startswith(F.upper(col), F.lit(p.upper())) for p in known])


def prefix_none(
    col: Column,
    kinds: Sequence[str] | None,
    prefixes: dict[str, str] = MODEL_PREFIX,
    null_as_empty: bool = True,
) -> Column:
    """The value starts with the prefix of none of `kinds`."""
    known = _prefixes(kinds, prefixes)
    if not known:
        return _all_rows()
    value = F.upper(F.coalesce(col, F.lit("")) if null_as_empty else col)
    return reduce(lambda a, b: a & b, [~F.startswith(value, F.lit(p.upper())) for p in known])


def key_is(keys: dict[str, object]) -> Column:
    """A key predicate in which a NULL part matches NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in keys.items()])


def unresolved(resolved: Column, dismissed: Column) -> Column:
    """Alerts still active: neither resolved nor dismissed."""
    return resolved.isNull() & dismissed.isNull()
