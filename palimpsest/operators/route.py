"""Semi joins that decide which records a feed keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route(
    feed: DataFrame,
    networks: DataFrame,
    product_type: str,
    key: str = "network_id",
    network_key: str = "id",
    types: str = "product_types",
) -> DataFrame:
    """Rows of a per-network feed whose network has the product type."""
    able = networks.where(F.array_contains(types, product_type)).select(
        F.col(network_key).alias(key)
    )
    return feed.join(able, key, "left_semi")


def scope(
    rows: DataFrame,
    networks: DataFrame,
    org_id: str,
    key: str = "network_id",
    network_key: str = "id",
    org: str = "organization_id",
) -> DataFrame:
    """Rows whose network belongs to the organization."""
    owned = networks.where(F.col(org) == F.lit(org_id)).select(F.col(network_key).alias(key))
    return rows.join(owned, key, "left_semi")
