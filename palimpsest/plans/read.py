"""The read surface: one function for stored tables, one for landed snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import predicates as P
from palimpsest.functions.times import Moment
from palimpsest.operators.convert import normalize
from palimpsest.operators.counters import for_month
from palimpsest.operators.history import at_time
from palimpsest.operators.route import scope
from palimpsest.sources.landing import read_landing
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.spec import Filter, ResourceSpec


def _predicate(spec: ResourceSpec, f: Filter, value, match: str, null_as_empty: bool) -> Column:
    col = F.col(f.column)
    if f.kind == "equals":
        return P.equals(col, value)
    if f.kind == "value":
        return P.equals_value(col, value)
    if f.kind == "text":
        return P.text(col, value, match, f.strip)
    if f.kind == "include":
        return P.has_all(col, value, null_as_empty)
    if f.kind == "exclude":
        return P.has_none(col, value, null_as_empty)
    if f.kind == "prefix_include":
        return P.prefix_any(col, value)
    if f.kind == "prefix_exclude":
        return P.prefix_none(col, value, null_as_empty=null_as_empty)
    if f.kind == "unresolved":
        return P.unresolved(F.col("resolved_at"), F.col("dismissed_at")) if value else F.lit(True)
    raise ValueError(f"{spec.name}: unknown filter kind {f.kind!r}")


def filtered(
    df: DataFrame,
    spec: ResourceSpec,
    filters: dict,
    match: str = "literal",
    null_as_empty: bool = True,
    networks: DataFrame | None = None,
    devices: DataFrame | None = None,
) -> DataFrame:
    """Rows that pass all given filters of the resource."""
    unknown = sorted(set(filters) - set(spec.filters))
    if unknown:
        raise ValueError(f"{spec.name}: unknown filter(s) {unknown}; known: {sorted(spec.filters)}")
    tests = []
    for name, value in filters.items():
        f = spec.filters[name]
        if f.kind in ("scope", "device_scope"):
            if not value:
                continue
            if networks is None:
                raise ValueError(f"{spec.name}: filter {name} needs the networks")
            if f.kind == "device_scope":
                if devices is None:
                    raise ValueError(f"{spec.name}: filter {name} needs the devices")
                owned = scope(devices, networks, value).select(F.col("serial").alias(f.column))
                df = df.join(owned, f.column, "left_semi")
            else:
                df = scope(df, networks, value, key=f.column)
        else:
            tests.append(_predicate(spec, f, value, match, null_as_empty))
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def read(
    spec: ResourceSpec,
    source: HistoryStore | KeyedStore | DataFrame,
    ts: Moment | None = None,
    *,
    month: int | None = None,
    year: int | None = None,
    now: Moment | None = None,
    match: str = "literal",
    null_as_empty: bool = True,
    networks: DataFrame | None = None,
    devices: DataFrame | None = None,
    ordered: bool = True,
    **filters,
) -> DataFrame:
    """Stored rows of a resource.

    `ts`: None for current rows, "all" for all versions, a time for the rows valid then.
    Counters take `month` and `year` instead, or `now` for the month it falls in.
    """
    if spec.versioned:
        if month or year:
            raise ValueError(f"{spec.name} is read by time, not by month")
        if isinstance(source, HistoryStore):
            # One value of the first key column names the bucket that can hold it.
            key = next(
                (v for n, v in filters.items() if n in spec.filters and spec.filters[n].kind in ("equals", "value") and v and spec.filters[n].column == source.keys[0]),
                None,
            )
            df = source.at(ts, key)
        else:
            df = at_time(source, ts)
    else:
        if ts is not None:
            raise ValueError(f"{spec.name} keeps no versions to look up by time")
        if now is None and not (month and year):
            raise ValueError(f"{spec.name} needs month and year, or now")
        if isinstance(source, KeyedStore):
            named = {"month": month, "year": year}
            rows = source.rows(**{c: v for c, v in named.items() if v and c in source.partition_by})
        else:
            rows = source
        df = for_month(rows, now if now is not None else "1970-01-01", month, year)
    df = filtered(df, spec, filters, match, null_as_empty, networks, devices)
    return df.orderBy(*[F.asc_nulls_last(c) for c in spec.sort]) if ordered and spec.sort else df


def snapshot(
    spark: SparkSession,
    spec: ResourceSpec,
    path: str,
    *,
    ts: Moment | None = None,
    match: str = "literal",
    null_as_empty: bool = True,
    networks: DataFrame | None = None,
    devices: DataFrame | None = None,
    strict: bool = True,
    **filters,
) -> DataFrame:
    """Landed rows of a resource, normalised and filtered."""
    if ts is not None:
        raise ValueError("a landed snapshot has no versions to look up by time")
    rows = normalize(read_landing(spark, path, spec), spec, strict)
    return filtered(rows, spec, filters, match, null_as_empty, networks, devices)
