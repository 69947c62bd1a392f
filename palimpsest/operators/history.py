"""History of keyed rows: versions with half-open validity, and the reads over them.

A version carries `active_from`, `active_to` (NULL while open) and `last_seen`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.canonical import same_row
from palimpsest.functions.times import Moment, moment
from palimpsest.operators.slices import (
    HOT,
    ROWS_PER_SLICE,
    SLICE,
    by_slice,
    found_hot,
    in_slice,
    sliced,
    summarise,
)
from palimpsest.session import written

VERSIONING = ("active_from", "active_to", "last_seen")


def history_from_log(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    at: str,
    tiebreak: Sequence[str] = (),
    json_cols: Sequence[str] = (),
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Versions from a log of observations: a version per run of equal values of a key.

    Equals merging the observations one after the other. Of several rows with the same key and
    time the last by `tiebreak` counts, so no version has zero length. The log
    crosses the network once, by key; detecting changes, dropping repeats and closing versions
    all use that one layout and sort. Repeats of a hot key at one time are reduced before that.
    A row without a time fails.
    """
    # A row without a time has no place in a history; dropping it would lose it unseen.
    timed = F.coalesce(F.col(at), F.raise_error(F.lit(f"{at} is NULL in a log")).cast(log.schema[at].dataType))
    log = log.withColumn(at, timed)
    rows, slicing = sliced(log.select(*keys, *values, at, *tiebreak), keys, at, rows_per_slice)
    state = F.struct(F.col(at).alias("at"), *values)
    if slicing:
        last = F.max_by(F.struct(*values, *tiebreak), F.struct(at, *tiebreak)).alias("_last")
        cold, hot = rows.where(~F.col(HOT)), rows.where(HOT)
        reduced = hot.groupBy(*keys, SLICE, HOT, at).agg(last).select(*keys, SLICE, HOT, at, "_last.*")
        rows = cold.unionByName(reduced)

    # What a slice inherits: the last row before it, and the last time its key was seen.
    if slicing:
        tails = summarise(
            rows, keys, F.max_by(state, F.struct(at, *tiebreak)).alias("_tail")
        )
        borders = tails.select(
            *keys,
            SLICE,
            F.lag("_tail").over(by_slice(keys)).alias("_before"),
            F.max("_tail.at").over(by_slice(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_end"),
        )

    w = in_slice(keys, at, *tiebreak)
    rows = rows.withColumn("_next_at", F.lead(at).over(w))
    rows = rows.where(F.col("_next_at").isNull() | (F.col("_next_at") != F.col(at)))
    rows = rows.withColumn("_prev", F.lag(state).over(w)).withColumn("_now", state)
    if slicing:
        rows = rows.join(borders, [*keys, SLICE], "left").withColumn(
            "_prev", F.coalesce("_prev", "_before")
        )
    unchanged = same_row(rows, values, "_now", "_prev", json_cols, types=log)
    rows = rows.withColumn("_start", F.col("_prev").isNull() | ~unchanged)

    # Only the starts of versions go on, and the last row of each slice: it says when an
    # unchanged value was seen last.
    marks = rows.where(F.col("_start") | F.col("_next_at").isNull()).withColumn(
        "_mark", F.struct(F.col(at).alias("at"), F.col("_prev.at").alias("seen"), "_start")
    )
    nxt = F.lead("_mark").over(w)
    closed_here = F.col("_nxt._start")
    later_seen = [F.col("_nxt.at"), F.col(at)]
    versions = marks.withColumn("_nxt", nxt)
    if slicing:
        heads = summarise(
            rows.where("_start"),
            keys,
            F.min_by(F.struct(F.col(at).alias("at"), F.col("_prev.at").alias("seen")), at).alias("_head"),
        )
        after = heads.select(*keys, SLICE, F.lead("_head").over(by_slice(keys)).alias("_after"))
        versions = versions.where("_start").join(after, [*keys, SLICE], "left")
        next_at = F.col("_after.at")
        later_seen = [F.col("_after.seen"), F.col("_end"), *later_seen]
    else:
        versions = versions.where("_start")
        next_at = F.lit(None).cast(log.schema[at].dataType)
    return versions.select(
        *keys,
        *values,
        F.col(at).alias("active_from"),
        F.when(closed_here, F.col("_nxt.at")).otherwise(next_at).alias("active_to"),
        F.when(closed_here, F.col("_nxt.seen")).otherwise(F.coalesce(*later_seen)).alias("last_seen"),
    )


def current(history: DataFrame) -> DataFrame:
    """Open versions."""
    return history.where(F.col("active_to").isNull())


def as_of(history: DataFrame, ts: Moment) -> DataFrame:
    """Versions valid at `ts`: from inclusive, to exclusive."""
    t = moment(ts, history.schema["active_from"].dataType)
    return history.where(
        (F.col("active_from") <= t) & ((F.col("active_to") > t) | F.col("active_to").isNull())
    )


def at_time(history: DataFrame, ts: Moment | None = None) -> DataFrame:
    """Current rows for None, all versions for "all", otherwise the rows valid at `ts`."""
    if ts is None:
        return current(history)
    if isinstance(ts, str) and ts == "all":
        return history
    return as_of(history, ts)


def stale(history: DataFrame, ts: Moment, max_age: str) -> DataFrame:
    """Open rows not seen for `max_age` (an interval text) before `ts`.

    A key that vanishes from the snapshots stays open; this finds it.
    """
    t = moment(ts, history.schema["last_seen"].dataType)
    return current(history).where(F.col("last_seen") < t - F.expr(f"interval {max_age}"))


def open_row_violations(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one open version: none in a sound history."""
    return (
        current(history)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("open_rows"))
        .where(F.col("open_rows") > 1)
    )


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    values: Sequence[str],
    how: str = "inner",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Each fact with the version of its key that was valid at the fact's time.

    Facts and version starts are put in one time order per key, and every fact takes the
    latest start before it. A key with many facts and many versions costs a sort, not
    their product. For hot keys this is done with their distinct times, cut into slices, and
    their facts join the result by key and time. `how` is "inner" or "left".
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type {how!r}")
    carried = ["active_from", "active_to", *values]
    # A fact without key or time has no version; such facts must not gather in one task.
    known = F.col(at).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    timed = facts.where(known)
    hot = None
    if rows_per_slice is not None:
        hot = found_hot(facts.select(*keys).union(history.select(*keys)), keys, rows_per_slice)
    if hot is None:
        joined = _matched(timed, history, keys, at, carried, None, how)
    else:
        only = hot.select(*keys)
        cold_facts, cold_history = (d.join(only, list(keys), "left_anti") for d in (timed, history))
        # What is cut is read several times.
        hot_facts, hot_history = (written(d.join(only, list(keys), "left_semi")) for d in (timed, history))
        times = hot_facts.select(*keys, at).distinct()
        found = _matched(times, hot_history, keys, at, carried, rows_per_slice)
        joined = _matched(cold_facts, cold_history, keys, at, carried, None, how).unionByName(
            hot_facts.join(found, [*keys, at], how).select(*facts.columns, *carried)
        )
    if how == "inner":
        return joined
    nothing = [F.lit(None).cast(history.schema[c].dataType).alias(c) for c in carried]
    return joined.unionByName(facts.where(~known).select("*", *nothing))


def _matched(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    carried: Sequence[str],
    rows_per_slice: int | None,
    how: str = "inner",
) -> DataFrame:
    """The facts, none without key or time, with the columns of their version."""
    kept = [c for c in facts.columns if c not in keys]
    version_type = history.select(F.struct(*carried)).schema[0].dataType
    fact_type = facts.select(F.struct(*kept)).schema[0].dataType
    # The wider type of the two, as a comparison in SQL takes it.
    time_type = facts.select(at).union(history.select("active_from")).schema[0].dataType
    entries = facts.select(
        *keys,
        F.col(at).cast(time_type).alias("_at"),
        F.struct(*kept).alias("_fact"),
        F.lit(None).cast(version_type).alias("_version"),
    ).unionByName(
        history.select(
            *keys,
            F.col("active_from").cast(time_type).alias("_at"),
            F.lit(None).cast(fact_type).alias("_fact"),
            F.struct(*carried).alias("_version"),
        )
    )
    rows, slicing = sliced(entries, keys, "_at", rows_per_slice)
    # At equal times the version comes first: validity includes its start.
    order = (F.col("_at"), F.col("_fact").isNotNull())
    so_far = in_slice(keys, *order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("_match", F.last("_version", ignorenulls=True).over(so_far))
    if slicing:
        tails = summarise(
            rows.where(F.col("_version").isNotNull()), keys, F.max_by("_version", "_at").alias("_tail")
        )
        # Slices without a version start have no tail: each tail covers all slices up to the next.
        slots = summarise(rows, keys, F.count(F.lit(1)).alias("_rows")).join(
            tails, [*keys, SLICE], "left"
        )
        earlier = by_slice(keys).rowsBetween(Window.unboundedPreceding, -1)
        before = slots.select(
            *keys, SLICE, F.last("_tail", ignorenulls=True).over(earlier).alias("_before")
        )
        filled = filled.join(before, [*keys, SLICE], "left").withColumn(
            "_match", F.coalesce("_match", "_before")
        )
    filled = filled.where(F.col("_fact").isNotNull())
    valid = F.col("_match").isNotNull() & (
        F.col("_match.active_to").isNull() | (F.col("_match.active_to") > F.col("_at"))
    )
    if how == "inner":
        filled = filled.where(valid)
    return filled.select(
        *[F.col(c) if c in keys else F.col(f"_fact.{c}").alias(c) for c in facts.columns],
        *[F.when(valid, F.col(f"_match.{c}")).alias(c) for c in carried],
    )
