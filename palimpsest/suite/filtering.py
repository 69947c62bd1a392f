"""Row predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import predicates as P
from palimpsest.suite.registry import query, table

BRANDS = {"one": "brand#1", "two": "Brand#2", "three": "Brand#3"}


def parts(spark, data):
    """Parts with their words as tags; the tags of one type are NULL, another has none."""
    words = F.when(F.col("p_type") == "PROMO", None).when(
        F.col("p_type") == "SMALL", F.array().cast("array<string>")
    )
    brand = F.when(F.col("p_type") != "LARGE", F.col("p_brand"))
    return table(spark, data, "part").select(
        "p_partkey",
        "p_name",
        "p_size",
        brand.alias("p_brand"),
        words.otherwise(F.split("p_name", " ")).alias("tags"),
    )


PARTS = """
with parts as (
  select p_partkey, p_name, p_size, case when p_type <> 'LARGE' then p_brand end as p_brand,
    case p_type when 'PROMO' then null when 'SMALL' then []::varchar[] else string_split(p_name, ' ') end as tags
  from part)
"""


@query("select p_partkey, p_name from part where contains(lower(p_name), lower('D Wi'))")
def filter_text_literal(spark, data):
    return table(spark, data, "part").where(P.text(F.col("p_name"), "D Wi")).select("p_partkey", "p_name")


@query("select p_partkey, p_name from part where p_name ilike '%R_d%W%'")
def filter_text_pattern(spark, data):
    return (
        table(spark, data, "part")
        .where(P.text(F.col("p_name"), "R_d%W", match="pattern"))
        .select("p_partkey", "p_name")
    )


@query("""
select p_partkey, 'a_b' as needle from part where contains(replace(lower(p_name), ' ', '_'), '_g')
""")
def filter_text_wildcard_is_literal(spark, data):
    """A literal needle with a wildcard character matches that character only."""
    name = F.translate("p_name", " ", "_")
    return (
        table(spark, data, "part").where(P.text(name, "_G")).select("p_partkey", F.lit("a_b").alias("needle"))
    )


@query(PARTS + """
select p_partkey from parts where list_has_all(coalesce(tags, []), ['red', 'widget'])
""")
def tags_include_all(spark, data):
    return parts(spark, data).where(P.has_all(F.col("tags"), ["red", "widget"])).select("p_partkey")


@query(PARTS + """
select p_partkey from parts where not list_has_any(coalesce(tags, []), ['red', 'bolt'])
""")
def tags_exclude_any(spark, data):
    return parts(spark, data).where(P.has_none(F.col("tags"), ["red", "bolt"])).select("p_partkey")


@query(PARTS + """
select p_partkey from parts
where list_has_all(coalesce(tags, []), ['small']) and not list_has_any(coalesce(tags, []), ['ring', 'gizmo'])
""")
def tags_include_exclude(spark, data):
    return (
        parts(spark, data).where(P.tags(F.col("tags"), ["small"], ["ring", "gizmo"])).select("p_partkey")
    )


@query(PARTS + "select p_partkey from parts where not list_has_any(tags, ['red', 'bolt'])")
def tags_null_is_unknown(spark, data):
    """The other reading of NULL tags: such rows never pass."""
    return (
        parts(spark, data)
        .where(P.tags(F.col("tags"), exclude=["red", "bolt"], null_as_empty=False))
        .select("p_partkey")
    )


@query(PARTS + "select p_partkey, p_brand from parts where p_brand ilike 'brand#1%' or p_brand ilike 'Brand#3%'")
def prefix_include(spark, data):
    """Kinds stand for prefixes; an unknown kind does not count."""
    chosen = P.prefix_any(F.col("p_brand"), ["one", "three", "unknown"], BRANDS)
    return parts(spark, data).where(chosen).select("p_partkey", "p_brand")


@query(PARTS + """
select p_partkey, p_brand from parts
where not coalesce(p_brand, '') ilike 'brand#1%' and not coalesce(p_brand, '') ilike 'brand#2%'
""")
def prefix_exclude(spark, data):
    chosen = P.prefix_none(F.col("p_brand"), ["one", "two"], BRANDS)
    return parts(spark, data).where(chosen).select("p_partkey", "p_brand")


@query(PARTS + "select p_partkey, p_brand from parts where not p_brand ilike 'brand#1%'")
def prefix_exclude_null_is_unknown(spark, data):
    chosen = P.prefix_none(F.col("p_brand"), ["one"], BRANDS, null_as_empty=False)
    return parts(spark, data).where(chosen).select("p_partkey", "p_brand")


@query("select count(*) as rows, count(distinct p_brand) as brands from part where p_type = 'PROMO'")
def filter_equality(spark, data):
    """Equality; an empty argument filters nothing."""
    chosen = P.equals(F.col("p_type"), "PROMO") & P.equals(F.col("p_brand"), "")
    return (
        table(spark, data, "part")
        .where(chosen)
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("p_brand").alias("brands"))
    )


@query("select c_custkey from customer where c_nationkey = 0")
def filter_zero_is_a_value(spark, data):
    chosen = P.equals_value(F.col("c_nationkey"), 0) & P.equals_value(F.col("c_mktsegment"), None)
    return table(spark, data, "customer").where(chosen).select("c_custkey")


@query(PARTS + "select p_partkey from parts where p_brand is null and p_size = 11")
def filter_key_with_null(spark, data):
    return parts(spark, data).where(P.key_is({"p_brand": None, "p_size": 11})).select("p_partkey")


@query("""
select o_orderkey from orders
where not (o_orderstatus = 'F') and not (o_orderpriority in ('4-NOT SPECIFIED', '5-LOW'))
""")
def filter_unresolved(spark, data):
    """Orders as alerts: resolved when finished, dismissed when of low priority."""
    when = F.col("o_orderdate").cast("string")
    resolved = F.when(F.col("o_orderstatus") == "F", when)
    dismissed = F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), when)
    return table(spark, data, "orders").where(P.unresolved(resolved, dismissed)).select("o_orderkey")
