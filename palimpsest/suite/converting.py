"""Raw records to rows and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions.canonical import json_canonical, json_text, same
from palimpsest.functions.casing import camel_values, snake_values
from palimpsest.operators.convert import (
    business_columns,
    declared_columns,
    explode_children,
    normalize,
    payload,
    with_resource_path,
)
from palimpsest.resources import SWITCHPORT, VLAN
from palimpsest.spec import Field, ResourceSpec
from palimpsest.suite.registry import query, table

# Customers as devices with ports: as many as the nation number says, and none at all for one
# segment. The children carry no key of their parent.
DEVICES = """
with devices as (
  select 'D' || c_custkey as serial, c_mktsegment, c_nationkey, unnest(range(c_nationkey)) as i
  from customer where c_mktsegment <> 'BUILDING')
"""


def devices(spark, data):
    port = lambda i: F.struct(
        (i + 1).cast("string").alias("portId"),
        F.concat(F.lit("port "), i.cast("string")).alias("name"),
        (i > 2).alias("poeEnabled"),
        F.lower("c_mktsegment").alias("type"),
        (i * 10).alias("vlan"),
        F.lit("ignored").alias("unknownKey"),
    )
    ports = F.transform(F.sequence(F.lit(0), F.col("c_nationkey") - 1), port)
    empty = F.slice(F.transform(F.sequence(F.lit(0), F.lit(0)), port), 1, 0)
    ports = F.when(F.col("c_nationkey") > 0, ports).otherwise(empty)
    return table(spark, data, "customer").select(
        F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("serial"),
        F.when(F.col("c_mktsegment") != "BUILDING", ports).alias("ports"),
    )


@query(DEVICES + """
select serial, (i + 1)::varchar as port_id, 'port ' || i as name, null::boolean as enabled,
  i > 2 as poe_enabled, lower(c_mktsegment) as type, (i * 10)::int as vlan
from devices
""")
def normalize_children(spark, data):
    """Nested ports to typed rows: names converted, unknown keys gone, missing ones NULL."""
    return normalize(devices(spark, data), SWITCHPORT).select(
        "serial", "port_id", "name", "enabled", "poe_enabled", "type", "vlan"
    )


@query(DEVICES + "select serial, i::int as rule_order, 'port ' || i as name from devices")
def explode_positions(spark, data):
    """The position of a child becomes a column."""
    rows = explode_children(devices(spark, data), "ports", ["serial"], "rule_order")
    return rows.select("serial", "rule_order", "name")


@query("""
select 'N' || c_nationkey as network_id, c_custkey::int as vlan_id, c_name as name,
  case when c_acctbal < 0 then 'debt' end as dhcp_handling,
  '{"enabled":' || case when c_acctbal > 0 then 'true' else 'false' end || ',"limits":{"a":[2,1],"z":'
    || c_nationkey || '}}' as ipv6
from customer
""")
def normalize_overrides(spark, data):
    """A key under another raw name and as text; nested JSON kept in canonical form."""
    raw = table(spark, data, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("networkId"),
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, "debt").alias("dhcpHandling"),
        F.struct(
            F.struct(F.col("c_nationkey").alias("z"), F.array(F.lit(2), F.lit(1)).alias("a")).alias("limits"),
            (F.col("c_acctbal") > 0).alias("enabled"),
        ).alias("ipv6"),
    )
    return normalize(raw, VLAN).select("network_id", "vlan_id", "name", "dhcp_handling", "ipv6")


ALERT_LIKE = ResourceSpec(
    name="order_alert",
    keys=("id",),
    fields=(
        Field("id", "bigint"),
        Field("org_id"),
        Field("network_id"),
        Field("network_name"),
        Field("alert_type", raw="type"),
    ),
    path="/organizations/{org_id}/alerts/{id}",
    flatten={"network_id": "network.id", "network_name": "network.name"},
)


@query("""
select o_orderkey as id, 'O' || o_orderstatus as org_id,
  case when o_orderstatus = 'P' then 'given' else 'N' || o_custkey end as network_id,
  case when o_orderpriority <> '5-LOW' then 'customer ' || o_custkey end as network_name,
  o_orderpriority as alert_type
from orders
""")
def normalize_flatten(spark, data):
    """A nested object fills the columns the record itself does not give."""
    customer = F.col("o_custkey").cast("string")
    raw = table(spark, data, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("O"), "o_orderstatus").alias("orgId"),
        F.when(F.col("o_orderstatus") == "P", "given").alias("networkId"),
        F.col("o_orderpriority").alias("type"),
        F.struct(
            F.concat(F.lit("N"), customer).alias("id"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("customer "), customer)).alias("name"),
        ).alias("network"),
    )
    return normalize(raw, ALERT_LIKE)


@query(DEVICES + """
select distinct lower(c_mktsegment) as type, (i * 10)::int as vlan, i > 2 as poe_enabled from devices
""")
def business_columns_only(spark, data):
    """Neither key nor versioning columns."""
    rows = normalize(devices(spark, data), SWITCHPORT)
    return business_columns(rows, SWITCHPORT).select("type", "vlan", "poe_enabled").distinct()


PORT_LIKE = ResourceSpec(
    name="customer_port", keys=("serial",), fields=(Field("serial"), Field("name")), path="/ports/{serial}"
)


@query("""
select 'D' || c_custkey as serial, c_name as name, timestamp '2024-01-01' as active_from,
  null::timestamp as active_to, timestamp '2024-01-02' as last_seen from customer
""")
def declared_columns_only(spark, data):
    """A stored table with a column the resource no longer has."""
    t = lambda text: F.lit(text).cast("timestamp_ntz")
    rows = table(spark, data, "customer").select(
        F.lit("legacy").alias("old_column"),
        F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("serial"),
        F.col("c_name").alias("name"),
        t("2024-01-01").alias("active_from"),
        F.lit(None).cast("timestamp_ntz").alias("active_to"),
        t("2024-01-02").alias("last_seen"),
    )
    return declared_columns(rows, PORT_LIKE)


@query("""
select o_orderpriority, o_orderstatus,
  lower(regexp_replace(regexp_replace(n, '([A-Z])', '_\\1', 'g'), '^_', '')) as snake, count(*) as rows
from (select *, case o_orderstatus when 'F' then 'isBoundToConfigTemplate' when 'O' then 'NetworkId'
        else 'publicIP' end || replace(o_orderpriority[3:], ' ', '') as n from orders)
group by all
""")
def names_to_snake(spark, data):
    base = (
        F.when(F.col("o_orderstatus") == "F", "isBoundToConfigTemplate")
        .when(F.col("o_orderstatus") == "O", "NetworkId")
        .otherwise("publicIP")
    )
    name = F.concat(base, F.translate(F.substring("o_orderpriority", 3, 100), " ", ""))
    return (
        table(spark, data, "orders")
        .groupBy("o_orderpriority", "o_orderstatus", snake_values(name).alias("snake"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query("""
select p_partkey, w[1] || upper(w[2][1]) || w[2][2:] || upper(lower(p_type)[1]) || lower(p_type)[2:] as camel
from (select *, string_split(p_name, ' ') as w from part)
""")
def names_to_camel(spark, data):
    snake = F.concat_ws("_", F.translate("p_name", " ", "_"), F.lower("p_type"))
    return table(spark, data, "part").select("p_partkey", camel_values(snake).alias("camel"))


CUSTOMER_FIELDS = [
    ("c_custkey", "id", False),
    ("c_name", "fullName", False),
    ("segment", "mktSegment", False),
    ("in_debt", "inDebt", False),
    ("tags", "tags", False),
    ("settings", "settings", True),
]


def customer_rows(spark, data):
    nation = F.col("c_nationkey").cast("string")
    return table(spark, data, "customer").select(
        "c_custkey",
        F.concat(F.lit('"'), "c_name", F.lit('"')).alias("c_name"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segment"),
        (F.col("c_acctbal") < 0).alias("in_debt"),
        F.array(F.lit("n"), nation).alias("tags"),
        F.when(F.col("c_acctbal") < 5000, F.concat(F.lit('{"n":'), nation, F.lit("}"))).alias("settings"),
    )


@query(r"""
select c_custkey, '{"id":' || c_custkey || ',"fullName":"\"' || c_name || '\"","mktSegment":'
  || case when c_mktsegment <> 'FURNITURE' then '"' || c_mktsegment || '"' else 'null' end
  || ',"inDebt":' || case when c_acctbal < 0 then 'true' else 'false' end
  || ',"tags":["n","' || c_nationkey || '"],"settings":'
  || case when c_acctbal < 5000 then '{"n":' || c_nationkey || '}' else 'null' end || '}' as payload
from customer
""")
def payloads(spark, data):
    """Rows as camelCase JSON objects; NULLs stay, JSON columns are not quoted."""
    return customer_rows(spark, data).select("c_custkey", payload(CUSTOMER_FIELDS).alias("payload"))


@query(r"""
select c_custkey, case when c_acctbal < 0 then '{"mktSegment":'
    || case when c_mktsegment <> 'FURNITURE' then '"' || c_mktsegment || '"' else 'null' end || ',"inDebt":true}'
  else '{"inDebt":false}' end as payload from customer
""")
def partial_payloads(spark, data):
    """Only the named fields, chosen per row."""
    only = F.when(F.col("in_debt"), F.array(F.lit("segment"), F.lit("in_debt"))).otherwise(
        F.array(F.lit("in_debt"))
    )
    rows = customer_rows(spark, data).withColumn("only", only)
    return rows.select("c_custkey", payload(CUSTOMER_FIELDS, F.col("only")).alias("payload"))


@query(DEVICES + """
select serial, (i + 1)::varchar as port_id, '/devices/' || serial || '/switch/ports/' || (i + 1) as resource_path
from devices
""")
def resource_paths(spark, data):
    rows = normalize(devices(spark, data), SWITCHPORT)
    return with_resource_path(rows, SWITCHPORT).select("serial", "port_id", "resource_path")


@query("""
select event_id, '{"a":{"x":[2,1],"y":null},"k":' || json_extract_string(props, '$.k') || '}' as canonical
from events
""")
def json_canonical_form(spark, data):
    """Key order and spacing go, list order stays."""
    k = F.get_json_object("props", "$.k")
    loose = F.concat(F.lit('{ "k" :  '), k, F.lit(' , "a": {"y": null, "x": [ 2, 1]} }'))
    return table(spark, data, "events").select("event_id", json_text(loose).alias("canonical"))


@query("""
with e as (select event_id, event_type, json_extract_string(props, '$.k') as k from events)
select event_type, count(*) filter (event_type in ('click', 'view', 'error')) as same, count(*) as rows
from e group by event_type
""")
def json_equality(spark, data):
    """Reordered keys and NULL against empty are equal; list order and plain text are not."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    left = (
        F.when(kind == "click", F.concat(F.lit('{"k": '), k, F.lit(', "j": [1]}')))
        .when(kind == "view", F.lit(None))
        .when(kind == "error", F.concat(F.lit("not json "), k))
        .when(kind == "purchase", F.concat(F.lit("[1, "), k, F.lit("000]")))
        .otherwise(k)
    )
    right = (
        F.when(kind == "click", F.concat(F.lit('{"j":[1],"k":'), k, F.lit("}")))
        .when(kind == "view", F.lit("[]"))
        .when(kind == "error", F.concat(F.lit("not json "), k))
        .when(kind == "purchase", F.concat(F.lit("["), k, F.lit("000, 1]")))
        .otherwise(F.concat(F.lit('"'), k, F.lit('"')))
    )
    events = table(spark, data, "events").select("event_type", left.alias("l"), right.alias("r"))
    equal = same(F.col("l"), F.col("r"), events.schema["l"].dataType, is_json=True)
    return events.groupBy("event_type").agg(
        F.count_if(equal).alias("same"), F.count(F.lit(1)).alias("rows")
    )


@query("""
select l_returnflag, l_linestatus, count(*) as rows,
  count(*) filter (l_returnflag = 'N' and l_linestatus = 'O') as empty from lineitem group by all
""")
def json_empty_is_null(spark, data):
    """Canonical text of an empty list or object is NULL."""
    text = F.when(
        (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"),
        F.when(F.col("l_linenumber") > 3, "[ ]").otherwise("{}"),
    ).otherwise(F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit("]")))
    return (
        table(spark, data, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(json_canonical(text).isNull()).alias("empty"))
    )
