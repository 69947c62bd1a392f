"""Sets of half-open intervals per group: union, difference, and what of a time span is still to be read.

A set is a frame of rows (group columns, start, end). Intervals may overlap, repeat and touch; empty ones, and those with a NULL
border, hold nothing. All work is by windows over the borders of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.times import Moment, midnight, moment, utc_date
from palimpsest.operators.counters import LOOKBACK, SPAN


def merged(rows: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """The same set with the fewest intervals: overlapping and touching ones become one."""
    order = Window.partitionBy(*by).orderBy(start, end)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col(start) > reached), 1).otherwise(0)
    held = rows.where(F.col(start) < F.col(end)).select(*by, start, end).distinct()
    islands = held.withColumn("_new", begins).withColumn("_island", F.sum("_new").over(order))
    return islands.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).select(*by, start, end)


def subtract(rows: DataFrame, without: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """What of `rows` no interval of `without` (same columns) covers, with the fewest intervals."""

    def borders(df: DataFrame, mine: int, theirs: int) -> DataFrame:
        some = df.where(F.col(start) < F.col(end))
        edges = F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d"))))
        edged = some.select(*by, edges.alias("_e"))
        return edged.select(*by, F.col("_e.t").alias("_t"), (F.col("_e.d") * mine).alias("_mine"), (F.col("_e.d") * theirs).alias("_theirs"))

    # Borders at one time are summed first, so every place of the sweep is one row.
    steps = borders(rows, 1, 0).unionByName(borders(without, 0, 1)).groupBy(*by, "_t").agg(F.sum("_mine").alias("_mine"), F.sum("_theirs").alias("_theirs"))
    order = Window.partitionBy(*by).orderBy("_t")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = steps.select(
        *by,
        F.col("_t").alias(start),
        F.lead("_t").over(order).alias(end),
        ((F.sum("_mine").over(so_far) > 0) & (F.sum("_theirs").over(so_far) == 0)).alias("_left"),
    )
    return merged(swept.where("_left"), by, start, end)


def plan_reads(
    groups: DataFrame, reads: DataFrame, by: Sequence[str], now: Moment, lookback: str = LOOKBACK, span: str = SPAN
) -> DataFrame:
    """For every group the pieces of time it has not read: t0, t1, and state.

    `reads` holds windows [t0, t1) that were read, in any order, with or without readings in them. A group's time begins
    where its first read does, or with the month of `now`, and ends with `now`. state is `lost` for what can no
    longer be read (before `lookback`), `next` for the first piece that can, cut to `span`, and `open` for what comes
    after that. A silent group moves on like any other, a window read twice counts once, and one that failed comes up again.
    """
    kind = reads.schema["t0"].dataType
    t = moment(now, kind)
    limit = t - F.expr(f"interval {lookback}")
    month = midnight(F.trunc(utc_date(t, kind), "month"), kind)
    first = reads.where(F.col("t0") < F.col("t1")).groupBy(*by).agg(F.min("t0").alias("_first"))
    whole = groups.select(*by).distinct().join(first, list(by), "left")
    whole = whole.select(*by, F.coalesce("_first", F.greatest(month, limit)).alias("t0"), t.alias("t1"))
    left = subtract(whole, reads.select(*by, "t0", "t1"), by, "t0", "t1")
    # A piece across the limit is two.
    cut = F.array(
        F.struct(F.col("t0").alias("a"), F.least(F.col("t1"), limit).alias("b"), F.lit(True).alias("lost")),
        F.struct(F.greatest(F.col("t0"), limit).alias("a"), F.col("t1").alias("b"), F.lit(False).alias("lost")),
    )
    pieces = left.select(*by, F.explode(F.filter(cut, lambda p: p["a"] < p["b"])).alias("p")).select(*by, "p.*")
    place = F.row_number().over(Window.partitionBy(*by, "lost").orderBy("a"))
    upto = F.least(F.col("b"), F.col("a") + F.expr(f"interval {span}"))
    parts = F.when(F.col("lost"), F.array(F.struct(F.col("a"), F.col("b"), F.lit("lost").alias("state"))))
    parts = parts.when(
        F.col("_place") == 1,
        F.array(
            F.struct(F.col("a"), upto.alias("b"), F.lit("next").alias("state")),
            F.struct(upto.alias("a"), F.col("b"), F.lit("open").alias("state")),
        ),
    ).otherwise(F.array(F.struct(F.col("a"), F.col("b"), F.lit("open").alias("state"))))
    split = pieces.withColumn("_place", place).select(*by, F.explode(F.filter(parts, lambda p: p["a"] < p["b"])).alias("p"))
    return split.select(*by, F.col("p.a").alias("t0"), F.col("p.b").alias("t1"), F.col("p.state").alias("state"))
