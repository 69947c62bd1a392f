"""Additive counters per key and calendar month, filled from incremental time windows.

Events count for the month of their own time. The reading windows are planned per group (an
organization), so one group's progress never moves another's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.times import Moment, midnight, moment, utc_date

# How far back a source can be read, and how much one reading covers.
LOOKBACK = "30 days"
SPAN = "14 days"

MONTH = ("month", "year")


def plan_windows(
    groups: DataFrame,
    state: DataFrame,
    by: Sequence[str],
    now: Moment,
    lookback: str = LOOKBACK,
    span: str = SPAN,
) -> DataFrame:
    """The next window [t0, t1) to read for every group.

    A group goes on from its latest `last_seen`, or starts at the first of the month; never
    earlier than `lookback` before `now`, and over at most `span`. What lies before that limit
    and was not read is lost, and named by `lost_from` and `lost_to`.
    """
    seen_type = state.schema["last_seen"].dataType
    t = moment(now, seen_type)
    limit = t - F.expr(f"interval {lookback}")
    month_start = midnight(F.trunc(utc_date(t, seen_type), "month"), seen_type)
    seen = state.groupBy(*by).agg(F.max("last_seen").alias("_seen"))
    plans = groups.select(*by).distinct().join(seen, list(by), "left")
    t0 = F.greatest(F.coalesce("_seen", month_start), limit)
    lost = F.col("_seen") < limit
    return plans.select(
        *by,
        t0.alias("t0"),
        F.least(t, t0 + F.expr(f"interval {span}")).alias("t1"),
        F.when(lost, F.col("_seen")).alias("lost_from"),
        F.when(lost, limit).alias("lost_to"),
    )


def in_windows(
    events: DataFrame, windows: DataFrame, by: Sequence[str], at: str
) -> DataFrame:
    """Events inside their group's window, with the window's end as `last_seen`.

    Windows of a size that Spark knows to be small (a local table, say) are broadcast by it. Events of no group,
    and those without a time, are in no window.
    """
    bounds = windows.select(*by, "t0", "t1")
    joined = events.join(bounds, list(by))
    inside = (F.col(at) >= F.col("t0")) & (F.col(at) < F.col("t1"))
    return joined.where(inside).withColumnRenamed("t1", "last_seen").drop("t0")


def monthly_delta(
    events: DataFrame, keys: Sequence[str], measures: Sequence[str], at: str
) -> DataFrame:
    """Sums per key, year and month of the event time; NULL counts as 0."""
    day = utc_date(F.col(at), events.schema[at].dataType)
    dated = events.withColumns({"month": F.month(day), "year": F.year(day)})
    return dated.groupBy(*keys, *MONTH).agg(
        *[F.sum(F.coalesce(F.col(m), F.lit(0))).cast("bigint").alias(m) for m in measures],
        F.max("last_seen").alias("last_seen"),
    )


def accumulate(
    state: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Stored counters plus a delta with unique keys; counters without delta stay as they are."""
    old = state.select(*keys, F.struct(*measures, "last_seen").alias("_old"))
    new = delta.select(*keys, F.struct(*measures, "last_seen").alias("_new"))
    both = old.join(new, list(keys), "full_outer")
    untouched = F.col("_new").isNull()
    zero = F.lit(0).cast("bigint")
    sums = [
        F.when(untouched, F.col(f"_old.{m}"))
        .otherwise(F.coalesce(F.col(f"_old.{m}"), zero) + F.coalesce(F.col(f"_new.{m}"), zero))
        .alias(m)
        for m in measures
    ]
    seen = F.coalesce("_new.last_seen", "_old.last_seen").alias("last_seen")
    return both.select(*keys, *sums, seen)


def for_month(
    counters: DataFrame, now: Moment, month: int | None = None, year: int | None = None
) -> DataFrame:
    """Counters of one month, by default that of `now` in UTC."""
    t = utc_date(moment(now), T.TimestampType())
    wanted_month = F.lit(month) if month else F.month(t)
    wanted_year = F.lit(year) if year else F.year(t)
    return counters.where((F.col("month") == wanted_month) & (F.col("year") == wanted_year))


def read_month(
    events: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    at: str,
    now: Moment,
    month: int | None = None,
    year: int | None = None,
    lookback: str = LOOKBACK,
    span: str = SPAN,
) -> DataFrame:
    """Usage of a month (that of `now` by default) straight from the events, without state.

    The reading starts with the month, but not before `lookback`, and covers at most `span`. What it
    holds of another month is left out.
    """
    dtype = events.schema[at].dataType
    t = moment(now, dtype)
    today = utc_date(t, dtype)
    first = F.make_date(
        F.lit(year) if year else F.year(today), F.lit(month) if month else F.month(today), F.lit(1)
    )
    start = midnight(first, dtype)
    t0 = F.greatest(start, t - F.expr(f"interval {lookback}"))
    t1 = F.least(t, t0 + F.expr(f"interval {span}"), midnight(F.add_months(first, 1), dtype))
    inside = events.where((F.col(at) >= t0) & (F.col(at) < t1)).withColumn("last_seen", t1)
    return monthly_delta(inside, keys, measures, at)


def split_late(events: DataFrame, at: str, now: Moment, lookback: str = LOOKBACK) -> DataFrame:
    """`events` with `late`: older than the source can be read back from `now`, or without a time."""
    limit = moment(now, events.schema[at].dataType) - F.expr(f"interval {lookback}")
    return events.withColumn("late", F.coalesce(F.col(at) < limit, F.lit(True)))
