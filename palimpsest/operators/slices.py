"""Splitting the ordered rows of hot keys over many tasks.

A window over `keys` puts all rows of one key in one task, which fails when a key holds a large
share of a log. `sliced` finds such keys and cuts each of them along its order into
slices. Windows then run per `(keys, SLICE)`, and what crosses a slice border is carried by
one summary row per slice. Keys that are not hot form the single slice 0.

Which keys are cut, and where, changes the speed of a job but never its result. So both are
estimated from a sample in small jobs of their own, before the plan is built; every row takes
part in the result. Without hot keys the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import written

SLICE = "_slice"
HOT = "_hot"

# A key with more rows than this is cut into slices of about so many.
ROWS_PER_SLICE = 4_000_000
# How many sampled rows stand for ROWS_PER_SLICE.
SAMPLE = 200
# Up to so many hot keys are handed to the plan as a local table; more are written to the shared folder. Either way
# Spark knows their size, they are sought once, and every part of a plan cuts at the same places.
LOCAL = 10_000
# Sampled rows of one key that are gathered for its borders; a key with more is thinned to that.
GATHERED = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame:
    """The keys above `rows_per_slice` rows, by the sample, with their row counts."""
    fraction = min(1.0, SAMPLE / rows_per_slice)
    counts = _sample(df.select(*keys), fraction).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.ceil(F.col("_n") / fraction).alias("_rows")
    return counts.select(*keys, rows).where(F.col("_rows") > rows_per_slice)


def _local(df: DataFrame) -> DataFrame:
    """The rows as a local table where they are few, and else from the shared folder."""
    kept = written(df)
    found = kept.limit(LOCAL + 1).toArrow()
    return kept.sparkSession.createDataFrame(found, kept.schema) if found.num_rows <= LOCAL else kept


def found_hot(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame | None:
    """The hot keys, or None if there are none."""
    hot = _local(hot_keys(df, keys, rows_per_slice))
    return None if hot.isEmpty() else hot


def _sample(df: DataFrame, fraction: float) -> DataFrame:
    return df if fraction >= 1 else df.sample(fraction, seed=1)


def _cuts(df: DataFrame, keys: Sequence[str], spot: Column, hot: DataFrame, rows_per_slice: int) -> DataFrame:
    """For every hot key, the borders of its slices: every so-manieth sampled place, in order."""
    fraction = min(1.0, SAMPLE / rows_per_slice)
    share = F.least(F.lit(1.0), GATHERED / (F.col("_rows") * fraction))
    gathered = F.array_sort(F.collect_list("_spot"))
    step = F.greatest(F.lit(1), F.floor(F.first("_share") * fraction * rows_per_slice)).cast("int")
    return (
        _sample(df.select(*keys, spot.alias("_spot")), fraction)
        .join(hot, list(keys))
        .withColumn("_share", share)
        .where(F.rand(2) < F.col("_share"))
        .groupBy(*keys)
        .agg(gathered.alias("_places"), step.alias("_step"))
        .withColumn("_every", F.filter("_places", lambda x, i: (i + 1) % F.col("_step") == 0))
        .select(*keys, F.array_distinct("_every").alias("_borders"))
    )


def _passed(borders: Column, spot: Column) -> Column:
    """How many of the ascending borders are not above the spot, by halving."""
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(30)), lambda k: F.call_function("shiftleft", F.lit(1), (30 - k).cast("int"))
    )
    here = F.filter(steps, lambda s: s <= F.size(borders))
    return F.aggregate(
        here,
        F.lit(0),
        lambda at, s: F.when((at + s <= F.size(borders)) & (F.try_element_at(borders, at + s) <= spot), at + s).otherwise(at),
    )


def sliced(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], rows_per_slice: int | None = ROWS_PER_SLICE
) -> tuple[DataFrame, bool]:
    """`df` with SLICE (0 for ordinary keys) and HOT (whether the key was cut), and whether any
    key was cut at all.

    Slices rise with `order`, one or several columns of any type that can be ordered, and rows that agree
    in all of them share a slice. `None` switches slicing off, for keys whose row count the caller
    knows to be bounded.
    """
    whole = df.withColumn(SLICE, F.lit(0).cast("bigint")).withColumn(HOT, F.lit(False))
    if rows_per_slice is None:
        return whole, False
    hot = found_hot(df, keys, rows_per_slice)
    if hot is None:
        return whole, False
    columns = [order] if isinstance(order, str) else list(order)
    spot = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
    cuts = _local(_cuts(df, keys, spot, hot, rows_per_slice))
    marked = df.join(cuts, list(keys), "left").withColumn(HOT, F.col("_borders").isNotNull())
    place = F.when(F.col(HOT), F.coalesce(_passed(F.col("_borders"), spot), F.lit(0))).otherwise(F.lit(0))
    return marked.withColumn(SLICE, place.cast("bigint")).drop("_borders"), True


def summarise(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """One row per slice of the hot keys: the input of a carry."""
    return df.where(F.col(HOT)).groupBy(*keys, SLICE).agg(*aggs)


def by_slice(keys: Sequence[str]):
    """Window over the slices of one key; its groups are as small as the slice count."""
    return Window.partitionBy(*keys).orderBy(SLICE)


def in_slice(keys: Sequence[str], *order):
    """Window over the rows of one slice."""
    return Window.partitionBy(*keys, SLICE).orderBy(*order)
