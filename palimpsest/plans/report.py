"""Reports over counters and current dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.units import gigabytes
from palimpsest.operators.history import current


def usage_report(usage: DataFrame, networks: DataFrame, ordered: bool = True) -> DataFrame:
    """Usage per uplink and month in gigabytes, with the current name of its network.

    Counters whose network is not current drop out. Latest month first, then names; NULLs
    stand first in the months and last in the names.
    """
    names = current(networks).select(F.col("id").alias("network_id"), F.col("name").alias("network_name"))
    out = usage.join(names, "network_id").select(
        "network_name",
        F.col("interface").alias("wan_interface"),
        "year",
        "month",
        gigabytes(F.col("sent")).alias("sent_gb"),
        gigabytes(F.col("received")).alias("received_gb"),
        gigabytes(F.col("sent") + F.col("received")).alias("total_gb"),
    )
    if not ordered:
        return out
    return out.orderBy(
        F.desc_nulls_first("year"),
        F.desc_nulls_first("month"),
        F.asc_nulls_last("network_name"),
        F.asc_nulls_last("wan_interface"),
    )
