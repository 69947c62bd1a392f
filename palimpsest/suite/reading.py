"""Landed JSON snapshots of every raw shape, the read surface, ad-hoc SQL and whole refreshes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.plans.read import read, snapshot
from palimpsest.plans.refresh import refresh
from palimpsest.resources import (
    ALERT,
    DEVICE,
    DHCP_SERVER_POLICY,
    L3_FIREWALL_RULE,
    NETWORK,
    ORGANIZATION,
    SWITCHPORT,
    UPLINK,
    UPLINK_USAGE,
    VLAN,
)
from palimpsest.sources.store import HistoryStore
from palimpsest.sources.views import open_store, register_views
from palimpsest.suite.registry import new_folder, query, table


def _text(col: str, prefix: str) -> F.Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _items(*names: str) -> F.Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def organizations(spark, data) -> DataFrame:
    return table(spark, data, "region").select(
        _text("r_regionkey", "R").alias("id"),
        F.col("r_name").alias("name"),
        F.struct(F.lit(True).alias("enabled")).alias("api"),
        F.lit("kept out").alias("somethingNew"),
    )


def networks(spark, data) -> DataFrame:
    region = F.col("n_regionkey")
    types = (
        F.when(region == 0, _items("switch", "appliance", "wireless"))
        .when(region == 1, _items("wireless"))
        .when(region == 2, _items("appliance"))
        .when(region == 3, _items("switch"))
    )
    return table(spark, data, "nation").select(
        _text("n_nationkey", "N").alias("id"),
        _text("n_regionkey", "R").alias("organizationId"),
        F.col("n_name").alias("name"),
        types.alias("productTypes"),
        F.when(region != 1, F.array(F.lower("n_name"), F.lit("all"))).alias("tags"),
        (region == 4).alias("isBoundToConfigTemplate"),
    )


def devices(spark, data, name: str = "c_name") -> DataFrame:
    """Customers as devices; the model tells the kind by its prefix."""
    segment = F.col("c_mktsegment")
    model = (
        F.when(segment == "BUILDING", F.concat(F.lit("MX"), F.col("c_nationkey").cast("string")))
        .when(segment == "FURNITURE", F.concat(F.lit("ms"), F.col("c_nationkey").cast("string")))
        .when(segment == "MACHINERY", F.concat(F.lit("MR"), F.col("c_nationkey").cast("string")))
        .when(segment == "HOUSEHOLD", F.lit("CW"))
    )
    return table(spark, data, "customer").select(
        _text("c_custkey", "S").alias("serial"),
        F.expr(name).alias("name"),
        _text("c_nationkey", "N").alias("networkId"),
        model.alias("model"),
        F.array(F.lower(segment)).alias("tags"),
        F.array(F.struct(F.lit("balance").alias("name"), (F.col("c_acctbal") > 0).alias("value"))).alias("details"),
    )


def uplinks(spark, data) -> DataFrame:
    """Parents with children: two uplinks, one, or no child array at all."""
    link = lambda name, status: F.struct(
        F.lit(name).alias("interface"),
        F.lit(status).alias("status"),
        F.concat(F.lit("10.0.0."), (F.col("c_nationkey")).cast("string")).alias("publicIp"),
        F.struct(F.col("c_nationkey").alias("rsrp")).alias("signalStat"),
    )
    children = F.when(F.col("c_acctbal") > 5000, F.array(link("wan1", "active"), link("wan2", "ready"))).when(
        F.col("c_acctbal") > 0, F.array(link("wan1", "failed"))
    )
    return table(spark, data, "customer").select(
        _text("c_custkey", "S").alias("serial"),
        _text("c_nationkey", "N").alias("networkId"),
        children.alias("uplinks"),
    )


def ports(spark, data) -> DataFrame:
    port = lambda i: F.struct(
        (i + 1).cast("string").alias("portId"),
        ((i % 2) == 0).alias("enabled"),
        F.when(i == 0, "trunk").otherwise("access").alias("type"),
        (i * 10).alias("vlan"),
    )
    return table(spark, data, "customer").select(
        _text("c_custkey", "S").alias("serial"),
        F.transform(F.sequence(F.lit(0), F.least(F.col("c_nationkey"), F.lit(3))), port).alias("ports"),
    )


def policies(spark, data) -> DataFrame:
    return table(spark, data, "nation").select(
        _text("n_nationkey", "N").alias("networkId"),
        F.when(F.col("n_regionkey") == 0, "block").otherwise("allow").alias("defaultPolicy"),
        F.array(F.lower("n_name")).alias("blockedServers"),
        F.struct(F.lit(False).alias("enabled")).alias("arpInspection"),
    )


def rules(spark, data) -> DataFrame:
    rule = lambda policy, port: F.struct(
        F.lit(policy).alias("policy"),
        F.lit("tcp").alias("protocol"),
        port.cast("string").alias("destPort"),
        F.lit(True).alias("syslogEnabled"),
    )
    both = F.array(rule("deny", F.col("n_nationkey") + 443), rule("allow", F.lit("Any")))
    return table(spark, data, "nation").select(
        _text("n_nationkey", "N").alias("networkId"), both.alias("rules")
    )


def vlans(spark, data, name: str = "s_name") -> DataFrame:
    return table(spark, data, "supplier").select(
        _text("s_nationkey", "N").alias("networkId"),
        F.col("s_suppkey").cast("string").alias("id"),
        F.expr(name).alias("name"),
        F.struct((F.col("s_acctbal") > 0).alias("enabled")).alias("mandatoryDhcp"),
    )


def alerts(spark, data) -> DataFrame:
    return table(spark, data, "orders").select(
        _text("o_orderkey", "A").alias("id"),
        F.lit("R1").alias("orgId"),
        F.col("o_orderpriority").alias("type"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("string")).alias("resolvedAt"),
        F.when(F.col("o_orderstatus") == "O", "critical").otherwise("warning").alias("severity"),
        F.struct(_text("o_custkey", "C").alias("id"), F.lit("a customer").alias("name")).alias("network"),
        F.struct(F.array(F.struct(_text("o_custkey", "S").alias("serial"))).alias("devices")).alias("scope"),
    )


def usage(spark, data) -> DataFrame:
    """Readings per order line in the service's nested form, by network and time."""
    lines = table(spark, data, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.sum(F.col("l_linenumber").cast("bigint")).alias("n")
    )
    suppliers = table(spark, data, "supplier").join(
        table(spark, data, "nation"), F.col("n_nationkey") == F.col("s_nationkey")
    )
    child = F.struct(
        _text("l_suppkey", "S").alias("serial"),
        F.lit("wan1").alias("interface"),
        F.col("q").alias("sent"),
        F.col("n").alias("received"),
    )
    return lines.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey")).select(
        _text("n_nationkey", "N").alias("networkId"),
        _text("n_regionkey", "R").alias("orgId"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.array(child).alias("byUplink"),
    )


def landed(spark, name: str, df: DataFrame) -> str:
    path = new_folder(spark, name)
    df.write.json(path)
    return path


@query("""
select 'N' || n_nationkey as id, 'R' || n_regionkey as organization_id, n_name as name,
  case n_regionkey when 0 then 'switch,appliance,wireless' when 1 then 'wireless' when 2 then 'appliance'
    when 3 then 'switch' end as product_types,
  case when n_regionkey <> 1 then lower(n_name) || ',all' end as tags,
  n_regionkey = 4 as is_bound_to_config_template, null::varchar as notes
from nation
""")
def landed_flat_list(spark, data):
    rows = snapshot(spark, NETWORK, landed(spark, "network", networks(spark, data)))
    return rows.select(
        "id",
        "organization_id",
        "name",
        F.array_join("product_types", ",").alias("product_types"),
        F.array_join("tags", ",").alias("tags"),
        "is_bound_to_config_template",
        "notes",
    )


@query("""
select 'S' || c_custkey as serial, 'N' || c_nationkey as network_id, interface,
  case when c_acctbal <= 5000 then 'failed' when interface = 'wan1' then 'active' else 'ready' end as status,
  '10.0.0.' || c_nationkey as public_ip, '{"rsrp":' || c_nationkey || '}' as signal_stat
from customer, (values ('wan1'), ('wan2')) i(interface)
where c_acctbal > 0 and (interface = 'wan1' or c_acctbal > 5000)
""")
def landed_parent_children(spark, data):
    rows = snapshot(spark, UPLINK, landed(spark, "uplink", uplinks(spark, data)))
    return rows.select("serial", "network_id", "interface", "status", "public_ip", "signal_stat")


@query("""
select 'N' || n_nationkey as network_id, case when n_regionkey = 0 then 'block' else 'allow' end as default_policy,
  lower(n_name) as blocked_servers, '{"enabled":false}' as arp_inspection from nation
""")
def landed_object_per_network(spark, data):
    rows = snapshot(spark, DHCP_SERVER_POLICY, landed(spark, "policy", policies(spark, data)))
    return rows.select(
        "network_id", "default_policy", F.array_join("blocked_servers", ",").alias("blocked_servers"), "arp_inspection"
    )


@query("""
select 'N' || n_nationkey as network_id, rule_order, case rule_order when 0 then 'deny' else 'allow' end as policy,
  case rule_order when 0 then (n_nationkey + 443)::varchar else 'Any' end as dest_port, true as syslog_enabled
from nation, (values (0), (1)) r(rule_order)
""")
def landed_rules(spark, data):
    rows = snapshot(spark, L3_FIREWALL_RULE, landed(spark, "rules", rules(spark, data)))
    return rows.select("network_id", "rule_order", "policy", "dest_port", "syslog_enabled")


@query("""
select 'N' || s_nationkey as network_id, s_suppkey::int as vlan_id, s_name as name,
  '{"enabled":' || case when s_acctbal > 0 then 'true' else 'false' end || '}' as mandatory_dhcp from supplier
""")
def landed_list_per_network(spark, data):
    rows = snapshot(spark, VLAN, landed(spark, "vlan", vlans(spark, data)))
    return rows.select("network_id", "vlan_id", "name", "mandatory_dhcp")


@query("""
select 'A' || o_orderkey as id, 'R1' as org_id, o_orderpriority as alert_type, 'C' || o_custkey as network_id,
  'a customer' as network_name, '{"devices":[{"serial":"S' || o_custkey || '"}]}' as scope
from orders where o_orderstatus = 'O'
""")
def landed_alerts(spark, data):
    """Alerts with their nested network, only critical unresolved ones."""
    path = landed(spark, "alert", alerts(spark, data))
    rows = snapshot(spark, ALERT, path, severity="critical", active_only=True)
    return rows.select("id", "org_id", "alert_type", "network_id", "network_name", "scope")


def stored(spark, data, spec, raw: DataFrame) -> HistoryStore:
    """A table with one snapshot of the landed records."""
    store = HistoryStore.of(spark, new_folder(spark, "tables"), spec)
    store.merge(snapshot(spark, spec, landed(spark, spec.name, raw)), "2024-01-01")
    return store


@query("""
select 'S' || c_custkey as serial, c_name as name, case c_mktsegment when 'BUILDING' then 'MX' || c_nationkey
    when 'MACHINERY' then 'MR' || c_nationkey end as model
from customer join nation on n_nationkey = c_nationkey
where n_regionkey = 2 and c_mktsegment in ('BUILDING', 'MACHINERY') and lower(c_name) like '%customer#%1%'
""")
def read_devices(spark, data):
    """Stored devices of one organization by kind, name pattern and tag."""
    store = stored(spark, data, DEVICE, devices(spark, data))
    nets = snapshot(spark, NETWORK, landed(spark, "network", networks(spark, data)))
    rows = read(
        DEVICE,
        store,
        org_id="R2",
        networks=nets,
        product_types_include=["appliance", "wireless"],
        tags_exclude=["furniture"],
        name="customer#%1",
        match="pattern",
    )
    return rows.select("serial", "name", "model")


@query("""
select 'S' || c_custkey as serial, '3' as port_id, 20 as vlan from customer where c_nationkey >= 2
""")
def read_switchports(spark, data):
    """Stored ports in the order of serial and port: enabled access ports."""
    store = stored(spark, data, SWITCHPORT, ports(spark, data))
    return read(SWITCHPORT, store, enabled=True, port_type="access").select("serial", "port_id", "vlan")


@query("""
select 'N' || n_nationkey as id, n_name as name from nation
where n_regionkey in (0, 2) and n_name <> 'NATION_7'
""")
def read_networks_at_time(spark, data):
    """Stored networks as of a time, by product type and tags."""
    store = stored(spark, data, NETWORK, networks(spark, data))
    rows = read(
        NETWORK,
        store,
        "2024-01-01 00:00:00",
        product_types_include=["appliance"],
        tags_include=["all"],
        tags_exclude=["nation_7"],
    )
    return rows.select("id", "name")


@query("""
select severity, count(*) as alerts from (
  select case when o_orderstatus = 'O' then 'critical' else 'warning' end as severity from orders)
group by severity having count(*) > 0
""")
def sql_over_views(spark, data):
    """Ad-hoc SQL over the stored tables by name."""
    root = new_folder(spark, "tables")
    store = open_store(spark, root, ALERT)
    store.merge(snapshot(spark, ALERT, landed(spark, "alert", alerts(spark, data))), "2024-01-01")
    register_views(spark, root)
    return spark.sql(
        "select severity, count(*) as alerts from alert where active_to is null group by severity"
    )


LANDINGS = {
    ORGANIZATION: organizations,
    NETWORK: networks,
    DEVICE: devices,
    UPLINK: uplinks,
    SWITCHPORT: ports,
    DHCP_SERVER_POLICY: policies,
    L3_FIREWALL_RULE: rules,
    VLAN: vlans,
    ALERT: alerts,
    UPLINK_USAGE: usage,
}


@query("""
with sizes as (
  select 'organization' as resource, count(*) as n from region
  union all select 'network', count(*) from nation
  union all select 'device', count(*) from customer
  union all select 'uplink', (select count(*) from customer where c_acctbal > 0) + (select count(*) from customer where c_acctbal > 5000)
  union all select 'switchport', (select sum(least(c_nationkey, 3) + 1)::bigint from customer)
  union all select 'dhcp_server_policy', count(*) from nation where n_regionkey in (0, 3)
  union all select 'l3_firewall_rule', count(*) * 2 from nation where n_regionkey in (0, 2)
  union all select 'vlan', count(*) from supplier join nation on n_nationkey = s_nationkey where n_regionkey in (0, 2)
  union all select 'ssid', count(*) from supplier join nation on n_nationkey = s_nationkey where n_regionkey in (0, 1)
  union all select 'appliance_malware', count(*) from nation where n_regionkey in (0, 2)
  union all select 'alert', count(*) from orders),
moved as (
  select 'device' as resource, count(*) as c from customer where c_acctbal < 0
  union all select 'vlan', count(*) from supplier join nation on n_nationkey = s_nationkey
    where n_regionkey in (0, 2) and s_acctbal < 0)
select resource, n as inserted, n - coalesce(c, 0) as updated, coalesce(c, 0) as replaced
from sizes left join moved using (resource)
""")
def refresh_twice(spark, data):
    """Two refreshes of landed snapshots; between them devices and vlans in debt get a new name.

    Returns, per resource, what the first refresh inserted and what the second did.
    """
    tables = new_folder(spark, "tables")
    # A balance of zero is no debt; the flags inside the records do not tell it from one.
    names = {DEVICE: "if(c_acctbal < 0, 'renamed', c_name)", VLAN: "if(s_acctbal < 0, 'renamed', s_name)"}

    def land(renamed: bool) -> str:
        root = new_folder(spark, "landing")
        for spec, make in LANDINGS.items():
            if not spec.versioned:
                continue
            raw = make(spark, data, names[spec]) if renamed and spec in names else make(spark, data)
            raw.write.json(f"{root}/{spec.name}")
        return root

    first = refresh(spark, land(False), tables, "2024-01-01")
    second = refresh(spark, land(True), tables, "2024-01-02")
    rows = [
        (name, first[name]["inserted"], second[name]["updated"], second[name]["expired+inserted"])
        for name in first
    ]
    return spark.createDataFrame(rows, "resource string, inserted bigint, updated bigint, replaced bigint")


@query("""
with e as (
  select n_nationkey, n_regionkey, l_suppkey, l_shipdate, l_quantity, l_linenumber
  from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey),
ends as (
  -- An organization without readings in the first window starts the second from the first again.
  select n_regionkey, case when count(*) filter (l_shipdate >= timestamp '1998-05-01' and l_shipdate < timestamp '1998-05-04') > 0
    then timestamp '1998-05-18' else timestamp '1998-05-15' end as t1
  from e group by 1)
select 'N' || n_nationkey as network_id, 'S' || l_suppkey as serial, 'wan1' as interface,
  year(l_shipdate)::int as year, month(l_shipdate)::int as month, sum(l_quantity::bigint)::bigint as sent,
  sum(l_linenumber::bigint)::bigint as received
from e join ends using (n_regionkey)
where l_shipdate >= timestamp '1998-05-01' and l_shipdate < t1
group by all
""")
def refresh_usage_counters(spark, data):
    """Two refreshes of the usage counters: from the first of the month, then from where it ended."""
    tables, root = new_folder(spark, "tables"), new_folder(spark, "landing")
    for spec in (ORGANIZATION, NETWORK, UPLINK_USAGE):
        LANDINGS[spec](spark, data).write.json(f"{root}/{spec.name}")
    names = ["uplink_usage"]
    for now in ("1998-05-04", "1998-05-18"):
        refresh(spark, root, tables, now, names)
    rows = open_store(spark, tables, UPLINK_USAGE).rows()
    return rows.select("network_id", "serial", "interface", "year", "month", "sent", "received")
