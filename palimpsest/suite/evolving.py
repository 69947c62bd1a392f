"""Schema evolution of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators.evolve import Add, Cast, Drop, Rename, downgrade, upgrade
from palimpsest.suite.registry import query, table

STEPS = (
    Rename("c_custkey", "serial"),
    Rename("c_name", "label"),
    Cast("number", "int"),
    Cast("tags", "array<string>"),
    Add("provider"),
    Drop("c_mktsegment"),
    Drop("never_there"),
)


def old_table(spark, data):
    nation = F.col("c_nationkey").cast("string")
    return table(spark, data, "customer").select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        nation.alias("number"),
        F.concat(F.lit('["'), "c_mktsegment", F.lit('","'), nation, F.lit('"]')).alias("tags"),
    )


@query("""
select c_custkey as serial, c_name as label, c_nationkey as number,
  c_mktsegment || '|' || c_nationkey as tags, null::varchar as provider from customer
""")
def evolve_upgrade(spark, data):
    """Rename, text to number, JSON text to array, add and drop."""
    return upgrade(old_table(spark, data), STEPS).withColumn("tags", F.array_join("tags", "|"))


@query("""
select c_custkey, c_name, c_nationkey::varchar as number,
  '["' || c_mktsegment || '","' || c_nationkey || '"]' as tags, null::varchar as c_mktsegment from customer
""")
def evolve_downgrade(spark, data):
    """All steps undone: a dropped column comes back without its values."""
    back = downgrade(upgrade(old_table(spark, data), STEPS), STEPS)
    return back.select("c_custkey", "c_name", "number", "tags", "c_mktsegment")
