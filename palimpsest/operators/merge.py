"""Merging snapshots into versioned history.

A merge takes the open versions and a batch, and returns one frame holding every row the new
state needs, tagged with where it belongs (PART) and what happened to it (OUTCOME):

    key in        business data   open part                        closed part           outcome
    batch only    -               new version from ts              -                     inserted
    both          same            old values, last_seen = ts       -                     updated
    both          different       new version from ts              old, active_to = ts   expired+inserted
    open only     -               as it was                        -                     NULL

One frame means one join and one write, whatever the sink does with the parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.canonical import same_row
from palimpsest.functions.times import Moment, moment
from palimpsest.operators.history import VERSIONING, history_from_log
from palimpsest.operators.slices import ROWS_PER_SLICE

PART = "_part"
OUTCOME = "_outcome"
OPEN, CLOSED = "open", "closed"

# The names of the outcomes.
INSERTED, UPDATED, REPLACED, UPSERTED = "inserted", "updated", "expired+inserted", "upserted"


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, failing at run time on a NULL in a key column."""
    checked = df
    for key in keys:
        message = F.lit(f"NULL in key column {key}")
        value = F.when(F.col(key).isNull(), F.raise_error(message).cast(df.schema[key].dataType))
        checked = checked.withColumn(key, value.otherwise(F.col(key)))
    return checked


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by `order`.

    An aggregate rather than a window: repeats of a hot key shrink before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*_spread(df, keys, "_last"))


def unique_or_fail(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, failing at run time when a key occurs twice.

    The count is combined before the shuffle: repeats of a hot key fail without gathering.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.first(F.struct(*rest)).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    repeated = F.raise_error(F.lit(f"key {', '.join(keys)} occurs more than once in the batch"))
    row_type = counted.schema["_first"].dataType
    row = F.when(F.col("_n") > 1, repeated.cast(row_type)).otherwise(F.col("_first"))
    return counted.select(*keys, row.alias("_row")).select(*_spread(df, keys, "_row"))


def _spread(df: DataFrame, keys: Sequence[str], struct: str) -> list[Column]:
    return [F.col(c) if c in keys else F.col(f"{struct}.{c}").alias(c) for c in df.columns]


def prepare_batch(
    batch: DataFrame, keys: Sequence[str], on_duplicate: str = "error", order: Sequence[str] = ()
) -> DataFrame:
    """A batch with non-NULL unique keys: repeats fail, or the last by `order` wins."""
    checked = require_keys(batch, keys)
    if on_duplicate == "error":
        return unique_or_fail(checked, keys)
    if on_duplicate == "last":
        if not order:
            raise ValueError("on_duplicate='last' needs the columns that order repeats")
        return latest(checked, keys, order)
    if on_duplicate == "trust":
        return checked
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}")


def scd2_merge(
    open_rows: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ts: Moment,
    json_cols: Sequence[str] = (),
    on_duplicate: str = "error",
    order: Sequence[str] = (),
    small_batch: bool = False,
) -> DataFrame:
    """Merges a snapshot taken at `ts` into the open versions.

    Only `keys` and `values` are read and compared; other columns of either side are ignored.
    A key missing from the batch stays open. `small_batch` says the batch fits a broadcast: the
    open side is then neither shuffled nor sorted. The caller checks the size (the store does).
    """
    require_columns(batch, [*keys, *values], "the batch")
    require_columns(open_rows, [*keys, *values, *VERSIONING], "the open side")
    t = moment(ts, open_rows.schema["active_from"].dataType)
    new = prepare_batch(batch, keys, on_duplicate, order).select(
        *keys, F.struct(*[F.col(v).cast(open_rows.schema[v].dataType).alias(v) for v in values]).alias("_new")
    )
    old = open_rows.select(*keys, F.struct(*values, *VERSIONING).alias("_old"))
    if small_batch:
        held = old.join(F.broadcast(new), list(keys), "left")
        known = old.select(*keys).join(F.broadcast(new.select(*keys)), list(keys), "left_semi")
        fresh = new.join(known, list(keys), "left_anti").select(
            *keys, F.lit(None).cast(old.schema["_old"].dataType).alias("_old"), "_new"
        )
        pairs = held.select(*keys, "_old", "_new").unionByName(fresh)
    else:
        pairs = old.join(new, list(keys), "full_outer")

    none = F.lit(None).cast(open_rows.schema["active_to"].dataType)

    def row(part: str, source: str, outcome: Column | None, **times: Column) -> Column:
        fields = [F.lit(part).alias(PART)]
        fields += [F.col(f"{source}.{v}").alias(v) for v in values]
        fields += [times[c].alias(c) for c in VERSIONING]
        fields.append((F.lit(None).cast("string") if outcome is None else outcome).alias(OUTCOME))
        return F.struct(*fields)

    old_from, old_seen = F.col("_old.active_from"), F.col("_old.last_seen")
    only_new = F.col("_old").isNull()
    only_old = F.col("_new").isNull()
    equal = same_row(pairs, values, "_new", "_old", json_cols, types=open_rows)

    def created(outcome: str) -> Column:
        return row(OPEN, "_new", F.lit(outcome), active_from=t, active_to=none, last_seen=t)

    closed = row(CLOSED, "_old", None, active_from=old_from, active_to=t, last_seen=old_seen)
    kept = row(OPEN, "_old", None, active_from=old_from, active_to=none, last_seen=old_seen)
    touched = row(OPEN, "_old", F.lit(UPDATED), active_from=old_from, active_to=none, last_seen=t)
    rows = (
        F.when(only_new, F.array(created(INSERTED)))
        .when(only_old, F.array(kept))
        .when(equal, F.array(touched))
        .otherwise(F.array(created(REPLACED), closed))
    )
    return pairs.select(*keys, F.explode(rows).alias("_r")).select(
        *keys, *[F.col(f"_r.{v}").alias(v) for v in values], *[F.col(f"_r.{c}").alias(c) for c in (*VERSIONING, PART, OUTCOME)]
    )


def open_part(merged: DataFrame) -> DataFrame:
    return merged.where(F.col(PART) == OPEN).drop(PART, OUTCOME)


def closed_part(merged: DataFrame) -> DataFrame:
    return merged.where(F.col(PART) == CLOSED).drop(PART, OUTCOME)


def outcome_columns(versioned: bool = True) -> list[Column]:
    """Counts per outcome as aggregates: for `agg`, or for `observe` during the write."""
    names = (INSERTED, UPDATED, REPLACED) if versioned else (UPSERTED,)
    return [F.count_if(F.coalesce(F.col(OUTCOME) == n, F.lit(False))).alias(n) for n in names]


def outcome_counts(merged: DataFrame) -> DataFrame:
    """One row (outcome, rows) per possible outcome of a merge, zeros included."""
    wide = merged.agg(*outcome_columns())
    return wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("outcome"), F.col(f"`{n}`").alias("rows")) for n in (INSERTED, UPDATED, REPLACED)])
        ).alias("_o")
    ).select("_o.*")


def keyed_upsert(
    base: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    ts: Moment,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """Replaces or adds whole rows by key; `last_seen` is the row's own, or else `ts`."""
    seen_type = base.schema["last_seen"].dataType
    t = moment(ts, seen_type)
    given = F.col("last_seen").cast(seen_type) if "last_seen" in batch.columns else F.lit(None)
    new = prepare_batch(batch, keys, on_duplicate, order).withColumn(
        "last_seen", F.coalesce(given, t)
    )
    return base.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*base.columns))


def merge_log(
    open_rows: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    at: str,
    tiebreak: Sequence[str] = (),
    json_cols: Sequence[str] = (),
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Appends a log batch, with several times per key, to history.

    The open versions of the touched keys re-enter as two observations, at `active_from` and at
    `last_seen`, and history is rebuilt from these and the batch. The batch must not be older
    than what the open versions have seen.
    """
    batch = require_keys(log, keys)
    touched = batch.select(*keys).distinct()
    known = open_rows.join(touched, list(keys), "left_semi")
    time_type = open_rows.schema["active_from"].dataType
    nulls = [F.lit(None).cast(log.schema[c].dataType).alias(c) for c in tiebreak]
    again = known.select(
        *keys,
        *values,
        F.explode(F.array("active_from", "last_seen")).alias(at),
        # Stored rows come before rows of the batch at the same time.
        F.lit(0).alias("_source"),
        *nulls,
    )
    fresh = batch.select(
        *keys,
        *[F.col(v).cast(open_rows.schema[v].dataType).alias(v) for v in values],
        F.col(at).cast(time_type).alias(at),
        F.lit(1).alias("_source"),
        *tiebreak,
    )
    rebuilt = history_from_log(
        again.unionByName(fresh), keys, values, at, ["_source", *tiebreak], json_cols, rows_per_slice
    )
    part = F.when(F.col("active_to").isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    untouched = open_rows.join(touched, list(keys), "left_anti").select(*rebuilt.columns)
    none = F.lit(None).cast("string").alias(OUTCOME)
    return rebuilt.select("*", part.alias(PART), none).unionByName(
        untouched.select("*", F.lit(OPEN).alias(PART), none)
    )


def rebuild_late(
    history: DataFrame,
    log: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    at: str,
    tiebreak: Sequence[str] = (),
    json_cols: Sequence[str] = (),
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """The history after observations that came late: their keys are rebuilt from the log and the
    late rows together, all others keep their versions.
    """
    touched = require_keys(late, keys).select(*keys).distinct()
    columns = [*keys, *values, at, *tiebreak]
    again = log.join(touched, list(keys), "left_semi").select(*columns).unionByName(late.select(*columns))
    rebuilt = history_from_log(again, keys, values, at, tiebreak, json_cols, rows_per_slice)
    kept = history.join(touched, list(keys), "left_anti").select(*rebuilt.columns)
    return kept.unionByName(rebuilt)
