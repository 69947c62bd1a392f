"""Longest-prefix match of addresses of both families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.addresses import MAPPED, address_number, is_ipv4, prefix_of


def prefix_lookup(
    points: DataFrame, prefixes: DataFrame, point: str, network: str, length: str, value: str, rank: str | None = None
) -> DataFrame:
    """The distinct addresses with the value of the longest prefix that holds them.

    `network` and `length` are an address and how many of its bits count (of an IPv4 address up to 32), the bits
    behind them do not matter. Of equal prefixes the highest `rank` wins, then the largest value. An IPv4
    address and its mapped IPv6 form are one. Addresses that no prefix holds, and texts that are none, are absent; so are
    prefixes of no address or of an impossible length.

    Addresses and prefixes meet in one equi join on the prefix, for the lengths that occur: no address is compared with a prefix that
    does not hold it.
    """
    bits = F.when(is_ipv4(F.col(network)), F.col(length) + MAPPED).otherwise(F.col(length)).cast("int")
    order = F.lit(0) if rank is None else F.col(rank)
    known = prefixes.select(
        address_number(F.col(network)).alias("_number"), bits.alias("_bits"), order.alias("_rank"), F.col(value).alias("_value"),
        F.col(length).alias("_length"),
    ).where(F.col("_number").isNotNull() & (F.col("_length") >= 0) & (F.col("_bits") <= 128))
    at = prefix_of(F.col("_number"), F.col("_bits"))
    best = (
        known.select("_bits", at.alias("_at"), "_rank", "_value")
        .groupBy("_bits", "_at")
        .agg(F.max(F.struct("_rank", "_value")).alias("_best"))
    )
    # At most 129 lengths, looked up before the plan is built; addresses are spread over those alone.
    used = sorted(r[0] for r in known.select("_bits").distinct().collect())
    lengths = F.array(*[F.lit(n) for n in used]).cast("array<int>")
    places = (
        points.select(F.col(point).alias("_point"))
        .where(F.col("_point").isNotNull())
        .distinct()
        .withColumn("_number", address_number(F.col("_point")))
        .where(F.col("_number").isNotNull())
        .withColumn("_bits", F.explode(lengths))
        .select("_point", "_bits", prefix_of(F.col("_number"), F.col("_bits")).alias("_at"))
    )
    return (
        places.join(best, ["_bits", "_at"])
        .groupBy("_point")
        .agg(F.max_by("_best._value", "_bits").alias("_value"))
        .select(F.col("_point").alias(point), F.col("_value").alias(value))
    )


def fill_by_prefix(
    df: DataFrame, prefixes: DataFrame, point: str, network: str, length: str, value: str, rank: str | None = None
) -> DataFrame:
    """`df` with NULLs of `value` filled by the longest prefix of the address in `point`; other rows are left alone."""
    keyed = df.withColumn("_ip", F.when(F.col(value).isNull(), F.col(point)))
    found = prefix_lookup(keyed, prefixes.withColumnRenamed(value, "_found"), "_ip", network, length, "_found", rank)
    # Rows that need no lookup match nothing; a name of their own spreads them over the join's tasks.
    unmatched = F.concat(F.lit("none "), F.xxhash64(F.monotonically_increasing_id()).cast("string"))
    joined = keyed.withColumn("_at", F.coalesce("_ip", unmatched)).join(
        found.select(F.col("_ip").alias("_at"), "_found"), "_at", "left"
    )
    return joined.withColumn(value, F.coalesce(value, "_found")).select(*df.columns)
