"""Enrichment, routing, differences and action batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators.actions import action, chunk_actions, update_actions
from palimpsest.operators.diff import changed_fields, field_diff
from palimpsest.operators.enrich import fill_by_range, ipv4_number, range_lookup, reuse
from palimpsest.operators.route import route, scope
from palimpsest.plans.refresh import enrich_uplinks
from palimpsest.resources import UPLINK
from palimpsest.spec import Field, ResourceSpec
from palimpsest.suite.merging import (
    CUSTOMER_BATCH,
    CUSTOMER_KEYS,
    CUSTOMER_VALUES,
    first_snapshot,
    second_snapshot,
)
from palimpsest.suite.registry import query, table

IP = "'10.' || (k // 65536) % 256 || '.' || (k // 256) % 256 || '.' || k % 256"

# Customers as uplinks with an address made from the key; one segment has none. The known
# uplinks are those not in debt, half of them with a provider; rich ones had another address.
UPLINKS = f"""
with base as (select c_custkey as k, * from customer),
fresh as (
  select k, 'S' || k as serial, 'wan1' as interface, c_acctbal, c_mktsegment,
    case when c_mktsegment <> 'FURNITURE' then {IP} end as public_ip from base),
known as (
  select serial as kserial, case when c_acctbal > 5000 then '1.2.3.4' else public_ip end as kip,
    case when c_mktsegment in ('BUILDING', 'FURNITURE', 'MACHINERY') then 'Known ' || c_mktsegment end as kprovider
  from fresh where c_acctbal >= 0),
served as (
  select f.*, case when kprovider is not null and kip is not distinct from public_ip then kprovider end as reused
  from fresh f left join known on kserial = serial),
registry as (
  select 167772160 + n_nationkey * 64 as lo, 167772160 + n_nationkey * 64 + 40 as hi, 26 as len, n_name as who
  from nation
  union all
  select 167772160 + r_regionkey * 512, 167772160 + r_regionkey * 512 + 511, 23, r_name from region)
"""


def uplinks(spark, data):
    k = F.col("c_custkey")
    ip = F.concat_ws(
        ".",
        F.lit("10"),
        F.expr("cast(c_custkey div 65536 % 256 as string)"),
        F.expr("cast(c_custkey div 256 % 256 as string)"),
        (k % 256).cast("string"),
    )
    return table(spark, data, "customer").select(
        F.concat(F.lit("S"), k.cast("string")).alias("serial"),
        F.lit("wan1").alias("interface"),
        F.when(F.col("c_mktsegment") != "FURNITURE", ip).alias("public_ip"),
        F.lit(None).cast("string").alias("provider"),
        "c_acctbal",
        "c_mktsegment",
    )


def known_uplinks(spark, data):
    old_ip = F.when(F.col("c_acctbal") > 5000, "1.2.3.4").otherwise(F.col("public_ip"))
    named = F.col("c_mktsegment").isin("BUILDING", "FURNITURE", "MACHINERY")
    return (
        uplinks(spark, data)
        .where(F.col("c_acctbal") >= 0)
        .withColumn("public_ip", old_ip)
        .withColumn("provider", F.when(named, F.concat(F.lit("Known "), "c_mktsegment")))
    )


def registry(spark, data):
    nation, region = table(spark, data, "nation"), table(spark, data, "region")

    def block(key, size, last, length, name):
        start = F.lit(167_772_160).cast("bigint") + F.col(key) * size
        return (
            start.alias("start"),
            (start + last).alias("end"),
            F.lit(length).alias("prefix_len"),
            F.col(name).alias("registrant"),
        )

    return nation.select(*block("n_nationkey", 64, 40, 26, "n_name")).unionByName(
        region.select(*block("r_regionkey", 512, 511, 23, "r_name"))
    )


@query(UPLINKS + "select serial, public_ip, reused as provider, reused is not null as reused from served")
def enrich_reuse(spark, data):
    """The known provider, while the address is unchanged (NULL equals NULL)."""
    return reuse(
        uplinks(spark, data), known_uplinks(spark, data), ["serial", "interface"], "public_ip", "provider"
    ).select("serial", "public_ip", "provider", "reused")


@query(UPLINKS + """
, found as (
  select s.serial, arg_max(who, len) as who from served s join registry
    on 167772160 + k between lo and hi where reused is null and public_ip is not null group by 1)
select served.serial, served.interface, public_ip, coalesce(reused, who) as provider
from served left join found on found.serial = served.serial
""")
def enrich_uplink_provider(spark, data):
    """Known providers, and for the rest the registrant of the most specific range."""
    return enrich_uplinks(
        uplinks(spark, data), known_uplinks(spark, data), registry(spark, data)
    ).select(*UPLINK.keys, "public_ip", "provider")


# Bands of account balance in cents: a broad one per region, narrow ones with gaps per nation.
BANDS = """
bands as (
  select r_regionkey * 220000 - 100000 as lo, r_regionkey * 220000 + 119999 as hi, 1 as rank, r_name as band from region
  union all
  select n_nationkey * 44000 - 100000, n_nationkey * 44000 - 70000, 2, n_name from nation)
"""


def bands(spark, data):
    nation, region = table(spark, data, "nation"), table(spark, data, "region")
    r, n = F.col("r_regionkey") * 220_000, F.col("n_nationkey") * 44_000
    return region.select(
        (r - 100_000).alias("lo"), (r + 119_999).alias("hi"), F.lit(1).alias("rank"), F.col("r_name").alias("band")
    ).unionByName(
        nation.select(
            (n - 100_000).alias("lo"), (n - 70_000).alias("hi"), F.lit(2).alias("rank"), F.col("n_name").alias("band")
        )
    )


@query(f"""
with p as (select distinct cast(round(c_acctbal * 100) as bigint) as cents from customer), {BANDS}
select cents, arg_max(band, rank) as band from p join bands on cents between lo and hi group by cents
""")
def range_lookup_bands(spark, data):
    """The most specific range of each number."""
    points = table(spark, data, "customer").select(F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"))
    return range_lookup(points, bands(spark, data), "cents", "lo", "hi", "band", "rank", bits=24)


@query(f"""
with {BANDS}, p as (select c_custkey, cast(round(c_acctbal * 100) as bigint) as cents,
    case when c_mktsegment = 'BUILDING' then 'fixed' end as band from customer),
f as (select c_custkey, arg_max(bands.band, rank) as found from p join bands on cents between lo and hi group by 1)
select p.c_custkey, coalesce(p.band, f.found) as band from p left join f on f.c_custkey = p.c_custkey
""")
def fill_missing_from_ranges(spark, data):
    rows = table(spark, data, "customer").select(
        "c_custkey",
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
        F.when(F.col("c_mktsegment") == "BUILDING", "fixed").alias("band"),
    )
    filled = fill_by_range(rows, bands(spark, data), F.col("cents"), "lo", "hi", "band", "rank", bits=24)
    return filled.select("c_custkey", "band")


@query(f"with base as (select c_custkey as k from customer) select k as c_custkey, k + 167772160 as number from base")
def address_numbers(spark, data):
    """IPv4 text as a number; the addresses are made from the keys."""
    rows = uplinks(spark, data).select(
        F.substring("serial", 2, 20).cast("bigint").alias("c_custkey"), "serial"
    )
    text = F.expr(
        "concat_ws('.', '10', cast(c_custkey div 65536 % 256 as string),"
        " cast(c_custkey div 256 % 256 as string), cast(c_custkey % 256 as string))"
    )
    return rows.select("c_custkey", ipv4_number(text).alias("number"))


PRODUCTS = """
with networks as (
  select n_nationkey as id, 'R' || n_regionkey as organization_id,
    case n_regionkey when 0 then ['switch', 'appliance', 'wireless'] when 1 then ['wireless']
      when 2 then ['appliance'] when 3 then []::varchar[] end as product_types
  from nation)
"""


def networks(spark, data):
    def items(*names):
        return F.array(*[F.lit(n) for n in names]).cast("array<string>")

    region = F.col("n_regionkey")
    types = (
        F.when(region == 0, items("switch", "appliance", "wireless"))
        .when(region == 1, items("wireless"))
        .when(region == 2, items("appliance"))
        .when(region == 3, items())
    )
    return table(spark, data, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.concat(F.lit("R"), region.cast("string")).alias("organization_id"),
        types.alias("product_types"),
    )


@query(PRODUCTS + """
select c_custkey, c_nationkey as network_id from customer
where c_nationkey in (select id from networks where list_contains(product_types, 'appliance'))
""")
def route_by_product_type(spark, data):
    """A feed keeps the rows of networks with the product type."""
    feed = table(spark, data, "customer").select("c_custkey", F.col("c_nationkey").alias("network_id"))
    return route(feed, networks(spark, data), "appliance")


@query(PRODUCTS + """
select c_custkey, c_nationkey as network_id from customer
where c_nationkey in (select id from networks where organization_id = 'R2')
""")
def scope_to_organization(spark, data):
    feed = table(spark, data, "customer").select("c_custkey", F.col("c_nationkey").alias("network_id"))
    return scope(feed, networks(spark, data), "R2")


CHANGES = f"""
with o as (select c_custkey, c_name, c_nationkey, c_mktsegment from customer),
b as (
  select c_custkey, case when c_nationkey < 3 then null else c_name end as c_name, c_nationkey, c_mktsegment
  from ({CUSTOMER_BATCH})),
j as (select o.c_custkey, o.c_name as n1, b.c_name as n2, o.c_mktsegment as s1, b.c_mktsegment as s2
  from o join b on b.c_custkey = o.c_custkey)
"""


def desired(spark, data):
    rows = second_snapshot(spark, data)
    return rows.withColumn("c_name", F.when(F.col("c_nationkey") >= 3, F.col("c_name")))


@query(CHANGES + """
select c_custkey, 'c_name' as field, n1 as left, n2 as right from j where n1 is distinct from n2
union all select c_custkey, 'c_mktsegment', s1, s2 from j where s1 is distinct from s2
""")
def diff_fields(spark, data):
    """Two sources compared field by field, on the keys both have."""
    return field_diff(
        first_snapshot(spark, data), desired(spark, data), CUSTOMER_KEYS, CUSTOMER_VALUES
    )


@query(CHANGES + """
select c_custkey, s2 as c_mktsegment, concat_ws(',',
    case when n1 is distinct from n2 then 'c_name' end,
    case when s1 is distinct from s2 then 'c_mktsegment' end) as fields
from j where n1 is distinct from n2 or s1 is distinct from s2
""")
def changed_field_names(spark, data):
    """Rows of the desired state that differ, and in which fields."""
    rows = changed_fields(
        desired(spark, data), first_snapshot(spark, data), CUSTOMER_KEYS, CUSTOMER_VALUES
    )
    return rows.select("c_custkey", "c_mktsegment", F.array_join("changed", ",").alias("fields"))


CUSTOMER = ResourceSpec(
    name="customer",
    keys=("c_custkey",),
    fields=(
        Field("c_custkey", "bigint"),
        Field("c_name", raw="fullName"),
        Field("c_nationkey", "int"),
        Field("c_mktsegment"),
    ),
    path="/customers/{c_custkey}",
)


@query(CHANGES + """
select c_custkey, '/customers/' || c_custkey as resource, 'update' as operation, '{' || concat_ws(',',
    case when n1 is distinct from n2 then '"fullName":' || coalesce('"' || n2 || '"', 'null') end,
    case when s1 is distinct from s2 then '"cMktsegment":"' || s2 || '"' end) || '}' as body
from j where n1 is distinct from n2 or s1 is distinct from s2
""")
def update_action_records(spark, data):
    """An update action per differing row with only the changed fields in its body."""
    rows = update_actions(desired(spark, data), first_snapshot(spark, data), CUSTOMER)
    return rows.select("c_custkey", "action.*")


CHUNKS = """
with a as (select o_orderpriority, o_orderkey,
    row_number() over (partition by o_orderpriority order by o_orderdate, o_orderkey) - 1 as n from orders)
select o_orderpriority, (n // {size})::bigint as chunk, count(*)::int as actions,
  string_agg('/orders/' || o_orderkey, ',' order by n) as resources from a group by 1, 2
"""


def order_chunks(spark, data, **options):
    orders = table(spark, data, "orders").select(
        "o_orderpriority",
        "o_orderdate",
        "o_orderkey",
        action(F.concat(F.lit("/orders/"), F.col("o_orderkey").cast("string")), F.lit("destroy")).alias("action"),
    )
    chunks = chunk_actions(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], **options)
    return chunks.select(
        "o_orderpriority",
        "chunk",
        F.size("actions").alias("actions"),
        F.array_join("actions.resource", ",").alias("resources"),
    )


@query(CHUNKS.format(size=100))
def action_chunks(spark, data):
    """Actions in batches of 100 per group."""
    return order_chunks(spark, data)


@query(CHUNKS.format(size=20))
def action_chunks_synchronous(spark, data):
    return order_chunks(spark, data, synchronous=True)


@query(CHUNKS.format(size=100))
def action_chunks_hot_group(spark, data):
    """The same with every group numbered slice by slice."""
    return order_chunks(spark, data, rows_per_slice=200)
