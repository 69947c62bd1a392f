"""Filling a column from earlier versions, and from ranges where those do not help."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Range lookup works on number blocks of 2**(STEP*level) numbers each.
STEP = 4
BITS = 32
# Largest blocks one range may have.
MOST = 4096


def ipv4_number(ip: Column) -> Column:
    """A dotted IPv4 address as a number; NULL for anything else."""
    parts = F.transform(F.split(ip, r"\."), lambda p: p.try_cast("int"))
    ok = ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & F.forall(
        parts, lambda p: p.isNotNull() & (p <= 255)
    )
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + p)
    return F.when(ok, number)


def reuse(
    fresh: DataFrame, known: DataFrame, keys: Sequence[str], by: str, value: str
) -> DataFrame:
    """`fresh` with `value` from the current version of the same key while `by` is unchanged.

    NULL equals NULL in `by`. A row not served keeps NULL, and `reused` says which it is.
    """
    # A join by sort: by the bytes of their compressed files, repetitive rows of any number would pass for a small broadcast.
    before = known.select(*keys, F.col(by).alias("_by"), F.col(value).alias("_value")).hint("merge")
    joined = fresh.drop(value).join(before, list(keys), "left")
    served = F.col("_value").isNotNull() & F.col("_by").eqNullSafe(F.col(by))
    return joined.select(
        *[c for c in fresh.columns if c != value],
        F.when(served, F.col("_value")).alias(value),
        F.coalesce(served, F.lit(False)).alias("reused"),
    )


def _floor_block(col: Column, level: Column) -> Column:
    return F.call_function("shiftright", col, (level * STEP).cast("int"))


def range_blocks(
    ranges: DataFrame, start: str, end: str, bits: int = BITS
) -> DataFrame:
    """Every inclusive range as the aligned blocks that make it up, largest first possible.

    At each level the pieces that do not fill a block of the next level are kept: fewer
    than 2*2**STEP per level, so a range of any length becomes a short list. A range so much longer than
    `bits` bits that it takes more than MOST blocks of the largest size fails.
    """
    levels = -(-bits // STEP)
    within = F.col(end).cast("bigint") - F.col(start) < MOST * 2 ** (STEP * levels)
    beyond = F.raise_error(F.lit(f"a range lies beyond {bits} bits")).cast("bigint")
    lo = F.when(within, F.col(start).cast("bigint")).otherwise(beyond)
    hi = F.when(within, F.col(end).cast("bigint") + 1).otherwise(beyond)
    level = F.col("_level")
    leveled = ranges.where(F.col(start) <= F.col(end)).withColumn(
        "_level", F.explode(F.sequence(F.lit(0), F.lit(levels)))
    )
    first = -_floor_block(-lo, level)
    last = _floor_block(hi, level)
    # Where whole blocks of the next level begin and end, in blocks of this level.
    inner_first = -_floor_block(-first, F.lit(1)) * 2**STEP
    inner_last = _floor_block(last, F.lit(1)) * 2**STEP
    top = level == levels
    empty = F.array().cast("array<bigint>")
    left_end = F.when(top, last).otherwise(F.least(inner_first, last))
    left = F.when(first < left_end, F.sequence(first, left_end - 1)).otherwise(empty)
    right_start = F.greatest(inner_last, left_end)
    right = F.when(~top & (right_start < last), F.sequence(right_start, last - 1)).otherwise(empty)
    return leveled.withColumn("_block", F.explode(F.concat(left, right)))


def range_lookup(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    start: str,
    end: str,
    value: str,
    rank: str,
    bits: int = BITS,
) -> DataFrame:
    """The distinct non-NULL points with the value of the best range that holds them.

    The highest `rank` wins, then the shortest and the lowest range, then the value. Points that
    no range holds are absent. Ranges and points meet in an equi join on aligned blocks: no
    point is compared with a range that does not hold it. Whole numbers only.
    """
    blocks = range_blocks(
        ranges.select(
            F.col(start).cast("bigint").alias("_start"),
            F.col(end).cast("bigint").alias("_end"),
            F.col(rank).alias("_rank"),
            F.col(value).alias("_value"),
        ),
        "_start",
        "_end",
        bits,
    )
    # One best range per block, so a block met by many points is met by one row.
    order = F.struct(
        F.col("_rank"), (F.col("_start") - F.col("_end")), -F.col("_start"), F.col("_value")
    )
    best = blocks.groupBy("_level", "_block").agg(F.max(order).alias("_best"))
    # Usually ranges need few of the levels; points are spread over those only. There are no more
    # than bits/STEP + 1 of them, so they are looked up before the plan is built.
    used = sorted(r[0] for r in blocks.select("_level").distinct().collect())
    levels = F.array(*[F.lit(level) for level in used]).cast("array<int>")
    places = (
        points.select(F.col(point).alias("_point"))
        .where(F.col("_point").isNotNull())
        .distinct()
        .withColumn("_level", F.explode(levels))
        .withColumn("_block", _floor_block(F.col("_point").cast("bigint"), F.col("_level")))
    )
    return (
        places.join(best, ["_level", "_block"])
        .groupBy("_point")
        .agg(F.max("_best").alias("_best"))
        .select(F.col("_point").alias(point), F.col("_best._value").alias(value))
    )


def fill_by_range(
    df: DataFrame,
    ranges: DataFrame,
    point: Column,
    start: str,
    end: str,
    value: str,
    rank: str,
    bits: int = BITS,
) -> DataFrame:
    """`df` with NULLs of `value` filled from the ranges; other rows are left alone."""
    keyed = df.withColumn("_point", F.when(F.col(value).isNull(), point))
    found = range_lookup(
        keyed, ranges.withColumnRenamed(value, "_found"), "_point", start, end, "_found", rank, bits
    )
    # Rows that need no lookup match nothing; hashing them spreads them over the join's tasks.
    spread = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    unmatched = F.concat(F.lit("none "), F.xxhash64(*spread).cast("string"))
    joined = keyed.withColumn("_at", F.coalesce(F.col("_point").cast("string"), unmatched)).join(
        found.select(F.col("_point").cast("string").alias("_at"), "_found"), "_at", "left"
    )
    return joined.withColumn(value, F.coalesce(value, "_found")).select(*df.columns)
