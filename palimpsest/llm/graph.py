"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.shared import cut, few_tasks


def _state(edges: DataFrame) -> tuple[int, bool]:
    """How many edges there are, and whether they are stars: no node of a larger end has two edges, or is a smaller end too."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    crossed = (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))
    r = nodes.agg(F.sum("up").alias("n"), F.max(crossed).alias("crossed")).first()
    return r["n"] or 0, not r["crossed"]


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) of every node of an edge.

    `edges` has two columns of one orderable type, in any direction; repeated edges and loops change nothing, rows
    with a null are no edges. Nodes without an edge to another node are not in the result.

    Each round replaces edges by stars: first every node hands its larger neighbours to its smallest one, then its
    smaller ones. Nodes with many edges are joined, never gathered; minima are combined before the shuffle. Rounds grow with
    the logarithm of the longest path and end once all edges are stars; each is cut from its lineage.
    """
    x, y = edges.columns
    now = cut(
        edges.where(F.col(x) != F.col(y))
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        .distinct()
    )
    count, stars = _state(now)
    while not stars:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A round makes no more edges than it took, but for a second one of each node.
        now = cut(few_tasks(small.union(low.select("u", F.col("m").alias("v"))).distinct(), 2 * count), now)
        count, stars = _state(now)
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("label"))
    )
