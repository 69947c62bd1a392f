"""Tables over several runs: streams on loaded tables, rows set aside, networks that leave, and what is refused."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.actions import chunk_actions, update_actions
from palimpsest.operators.convert import normalize
from palimpsest.operators.evolve import empty_table
from palimpsest.operators.history import as_of_join, history_from_log
from palimpsest.operators.merge import keyed_upsert
from palimpsest.plans.read import read, snapshot
from palimpsest.plans.refresh import refresh
from palimpsest.resources import (
    APPLIANCE_MALWARE,
    DEVICE,
    DHCP_SERVER_POLICY,
    L3_FIREWALL_RULE,
    NETWORK,
    ORGANIZATION,
    SSID,
    UPLINK_USAGE,
    VLAN,
)
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.sources.views import open_store, register_views
from palimpsest.spec import Field, ResourceSpec
from palimpsest.streaming.ingest import late_events, stream_counters, stream_log, stream_snapshots
from palimpsest.suite.counting import COUNTER_KEYS
from palimpsest.suite.merging import (
    CUSTOMER_KEYS,
    CUSTOMER_MERGE,
    EVENT_SCHEMA,
    T0,
    T1,
    first_snapshot,
    opened,
    second_snapshot,
)
from palimpsest.suite.reading import LANDINGS, landed, networks, policies, rules, stored, vlans
from palimpsest.suite.registry import new_folder, query, table
from palimpsest.suite.versions import EVENT_HISTORY, ORDER_HISTORY, order_history


@query(EVENT_HISTORY + "select * from h")
def load_then_stream(spark, data):
    """A table loaded with the history of half the events and continued by a stream of the rest."""
    events = table(spark, data, "events").select("user_id", "ts", "event_id", "event_type")
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    store = HistoryStore(spark, new_folder(spark, "events"), ["user_id"], EVENT_SCHEMA, buckets=4)
    first = events.where(F.col("ts") < half)
    store.load(history_from_log(first, ["user_id"], ["event_type"], "ts", ["event_id"]), "2024-01-15")
    landing = new_folder(spark, "landing")
    events.where(F.col("ts") >= half).write.parquet(landing)
    stream = spark.readStream.schema(events.schema).parquet(landing)
    stream_log(stream, store, "ts", ["event_id"]).awaitTermination()
    return store.history()


@query(CUSTOMER_MERGE + """
select c_custkey, c_name, c_nationkey, c_mktsegment, active_from, active_to, last_seen from m
""")
def stream_snapshots_customer(spark, data):
    """Two snapshots taken up by a stream, on a table that had a commit before."""
    schema = opened(first_snapshot(spark, data), T0).schema
    store = HistoryStore(spark, new_folder(spark, "customers"), CUSTOMER_KEYS, schema, buckets=4)
    store.merge(first_snapshot(spark, data), T0)
    landing = new_folder(spark, "landing")
    second_snapshot(spark, data).coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    for _ in range(2):  # the second run finds nothing new
        stream_snapshots(stream, store, lambda number: T1).awaitTermination()
    return store.history()


LATE = "2001-06-01 00:00:00"


@query(f"""
with e as (select l_suppkey, l_quantity::bigint as quantity, case when l_linenumber <> 7 then l_shipdate end as ts from lineitem)
select 'counted' as part, l_suppkey, year(ts)::int as year, month(ts)::int as month, sum(quantity)::bigint as quantity
from e where ts >= timestamp '{LATE}' - interval 30 day group by all
union all
select 'set aside', l_suppkey, null, null, sum(quantity)::bigint
from e where ts is null or ts < timestamp '{LATE}' - interval 30 day group by all
""")
def stream_counters_late_and_null(spark, data):
    """Counters of a stream, and the events it set aside as late or without a time: together all of them."""
    lines = table(spark, data, "lineitem").select(
        "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("ts"),
    )
    landing = new_folder(spark, "landing")
    lines.write.parquet(landing)
    schema = T.StructType.fromDDL("l_suppkey bigint, year int, month int, quantity bigint, last_seen timestamp")
    store = KeyedStore(spark, new_folder(spark, "counters"), COUNTER_KEYS, schema, ["year", "month"])
    stream = spark.readStream.schema(lines.schema).parquet(landing)
    stream_counters(stream, store, ["quantity"], "ts", LATE).awaitTermination()
    counted = store.rows().select(F.lit("counted").alias("part"), "l_suppkey", "year", "month", "quantity")
    none = F.lit(None).cast("int")
    aside = late_events(store, lines).groupBy("l_suppkey").agg(F.sum("quantity").alias("quantity"))
    return counted.union(aside.select(F.lit("set aside"), "l_suppkey", none, none, "quantity"))


@query(ORDER_HISTORY + """
select o.o_orderkey, o.o_custkey, o.d, n.active_from, n.o_orderpriority
from (select o_orderkey, o_custkey, o_orderdate::date + 30 as d from orders) o
join (select o_custkey, o_orderpriority, active_from + interval 12 hour as active_from, active_to + interval 12 hour as active_to from h) n
  on n.o_custkey = o.o_custkey and n.active_from <= o.d::timestamp and (n.active_to > o.d::timestamp or n.active_to is null)
""")
def as_of_join_dates(spark, data):
    """Facts of a day on versions that begin at noon: a version of that day is not valid at its midnight."""
    noon = F.expr("interval 12 hours")
    versions = order_history(spark, data).withColumns(
        {"active_from": F.col("active_from") + noon, "active_to": F.col("active_to") + noon}
    )
    day = F.date_add(F.to_date("o_orderdate"), 30)
    facts = table(spark, data, "orders").select("o_orderkey", "o_custkey", day.alias("d"))
    joined = as_of_join(facts, versions, ["o_custkey"], "d", ["o_orderpriority"])
    return joined.select("o_orderkey", "o_custkey", "d", "active_from", "o_orderpriority")


@query("""
with a as (
  select 'N' || c_nationkey as network_id, c_mktsegment, 'S' || lpad(c_custkey::varchar, 9, '0') as serial, limit_of.size,
    row_number() over (partition by c_nationkey, limit_of.size order by 'S' || lpad(c_custkey::varchar, 9, '0')) - 1 as place
  from customer, (values (100), (20)) limit_of(size) where c_acctbal < 0)
select network_id, size, (place // size)::bigint as chunk, count(*) as actions, min(serial) as first, max(serial) as last
from a group by all
""")
def write_back_chunks(spark, data):
    """From desired and current devices to updates in chunks, keyed by a text; networks are cut into slices."""
    current = table(spark, data, "customer").select(
        F.concat(F.lit("S"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("serial"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("network_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal"),
    )
    wanted = F.when(F.col("c_acctbal") < 0, F.lit("renamed")).otherwise(F.col("name"))
    raw = current.withColumnRenamed("network_id", "networkId")
    now = stored(spark, data, DEVICE, raw.drop("c_acctbal")).open_rows()
    desired = new_folder(spark, "desired")
    snapshot(spark, DEVICE, landed(spark, "device", raw.withColumn("name", wanted))).write.parquet(desired)
    found = update_actions(spark.read.parquet(desired), now, DEVICE).join(now.select("serial", "network_id"), "serial")
    # Chunks are made twice, and slicing looks at its input more than once.
    folder = new_folder(spark, "actions")
    found.write.parquet(folder)
    actions = spark.read.parquet(folder)
    parts = []
    for size, synchronous in ((100, False), (20, True)):
        chunks = chunk_actions(actions, ["network_id"], ["serial"], synchronous, rows_per_slice=50)
        path = F.col("actions")[0]["resource"]
        parts.append(
            chunks.select(
                "network_id",
                F.lit(size).alias("size"),
                "chunk",
                F.size("actions").cast("bigint").alias("actions"),
                F.element_at(F.split(path, "/"), -1).alias("first"),
                F.element_at(F.split(F.element_at("actions", -1)["resource"], "/"), -1).alias("last"),
            )
        )
    return parts[0].union(parts[1])


SPOT = "case c_nationkey % 5 when 0 then 'a:b' when 1 then 'c/d e' when 2 then '50%' when 3 then null else '' end"


@query(f"""
select {SPOT} as spot, c_custkey, case when c_custkey % 3 = 0 then 'new' else c_name end as c_name from customer
""")
def store_keyed_text_partitions(spark, data):
    """A keyed table by a text with signs that no folder's name may hold, and NULL."""
    kind = F.col("c_nationkey") % 5
    spot = F.when(kind == 0, "a:b").when(kind == 1, "c/d e").when(kind == 2, "50%").when(kind == 4, "")
    rows = table(spark, data, "customer").select(spot.alias("spot"), "c_custkey", "c_name")
    schema = T.StructType.fromDDL("spot string, c_custkey bigint, c_name string, last_seen timestamp_ntz")
    store = KeyedStore(spark, new_folder(spark, "spots"), ["spot", "c_custkey"], schema, ["spot"])

    def put(batch, ts):
        # A NULL in a key is refused by an upsert of its own; here it is a value like others.
        known = F.coalesce("spot", F.lit("<none>"))
        bare = lambda df: df.withColumn("spot", F.when(F.col("spot") != "<none>", F.col("spot")))
        combine = lambda held, new: bare(
            keyed_upsert(held.withColumn("spot", known), new.withColumn("spot", known), store.keys, ts)
        )
        store.change(batch, ts, combine)

    put(rows, T0)
    put(rows.where("c_custkey % 3 = 0").withColumn("c_name", F.lit("new")), T1)
    return store.rows().select("spot", "c_custkey", "c_name")


def ssids(spark, data):
    """Suppliers as wireless networks, with a secret."""
    return table(spark, data, "supplier").select(
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("networkId"),
        F.col("s_suppkey").cast("int").alias("number"),
        F.col("s_name").alias("name"),
        (F.col("s_acctbal") > 0).alias("enabled"),
        F.lit("secret").alias("psk"),
        F.array(F.struct(F.lit("10.0.0.1").alias("host"), F.col("s_nationkey").alias("port"))).alias("radiusServers"),
        F.array(F.lower("s_name")).alias("walledGardenRanges"),
    )


def malware(spark, data):
    return table(spark, data, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("networkId"),
        F.when(F.col("n_regionkey") == 0, "enabled").otherwise("disabled").alias("mode"),
        F.array(F.struct(F.lower("n_name").alias("url"))).alias("allowedUrls"),
    )


LANDINGS[SSID] = ssids
LANDINGS[APPLIANCE_MALWARE] = malware


@query("""
select 'N' || s_nationkey as network_id, s_suppkey::int as number, s_name as name, s_acctbal > 0 as enabled, 'secret' as psk,
  '[{"host":"10.0.0.1","port":' || s_nationkey || '}]' as radius_servers, lower(s_name) as ranges from supplier
""")
def landed_ssids(spark, data):
    rows = snapshot(spark, SSID, landed(spark, "ssid", ssids(spark, data)))
    ranges = F.array_join("walled_garden_ranges", ",").alias("ranges")
    return rows.select("network_id", "number", "name", "enabled", "psk", "radius_servers", ranges)


@query("""
select 'N' || n_nationkey as network_id, case when n_regionkey = 0 then 'enabled' else 'disabled' end as mode,
  '[{"url":"' || lower(n_name) || '"}]' as allowed_urls from nation
""")
def landed_malware(spark, data):
    rows = snapshot(spark, APPLIANCE_MALWARE, landed(spark, "malware", malware(spark, data)))
    return rows.select("network_id", "mode", "allowed_urls")


@query("""
select 'N' || s_nationkey as network_id, count(*) as ssids, count(*) filter (s_acctbal > 0) as enabled, false as shows_secret
from supplier group by all
""")
def sql_over_bucketed_views(spark, data):
    """Ad-hoc SQL over a table of several buckets; its secrets are not in the view."""
    root = new_folder(spark, "tables")
    HistoryStore.of(spark, root, SSID, buckets=4).merge(snapshot(spark, SSID, landed(spark, "ssid", ssids(spark, data))), T0)
    register_views(spark, root)
    shows = "psk" in spark.table("ssid").columns
    return spark.sql(f"""
        select network_id, count(*) as ssids, count_if(enabled) as enabled, {str(shows).lower()} as shows_secret
        from ssid where active_to is null group by network_id""")


@query("""
select 'N' || n_nationkey as network_id, 'S' || l_suppkey as serial, 'wan1' as interface, year(l_shipdate)::int as year,
  month(l_shipdate)::int as month, sum(l_quantity::bigint)::bigint as sent, sum(l_linenumber::bigint)::bigint as received
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
where l_shipdate >= timestamp '1998-05-01' and l_shipdate < timestamp '1998-05-11 12:00:00' group by all
""")
def refresh_usage_network_leaves(spark, data):
    """Usage refreshed, then again with every other network gone: no reading counts twice.

    No reading lies between the two, so the second refresh has nothing to add.
    """
    tables = new_folder(spark, "tables")
    for step, now in enumerate(("1998-05-11 12:00:00", "1998-05-11 12:00:01")):
        root = new_folder(spark, "landing")
        for spec in (ORGANIZATION, UPLINK_USAGE):
            LANDINGS[spec](spark, data).write.json(f"{root}/{spec.name}")
        here = networks(spark, data)
        if step:
            here = here.where(F.substring("id", -1, 1).cast("int") % 2 == 0)
        here.write.json(f"{root}/network")
        refresh(spark, root, tables, now, ["uplink_usage"])
    rows = open_store(spark, tables, UPLINK_USAGE).rows()
    return rows.select("network_id", "serial", "interface", "year", "month", "sent", "received")


@query("""
select 'N' || n_nationkey as network_id, 'S' || l_suppkey as serial, sum(l_quantity::bigint)::bigint as sent
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
where l_shipdate >= timestamp '1998-05-01' and l_shipdate < timestamp '1998-05-11' and n_nationkey = 3 group by all
""")
def read_usage(spark, data):
    """Stored counters of a month, by network: other months' files are not read."""
    tables, root = new_folder(spark, "tables"), new_folder(spark, "landing")
    for spec in (ORGANIZATION, NETWORK, UPLINK_USAGE):
        LANDINGS[spec](spark, data).write.json(f"{root}/{spec.name}")
    refresh(spark, root, tables, "1998-05-11", ["uplink_usage"])
    store = open_store(spark, tables, UPLINK_USAGE)
    return read(UPLINK_USAGE, store, month=5, year=1998, network_id="N3").select("network_id", "serial", "sent")


@query("""
select 'N' || n_nationkey as network_id, rule_order, row_number() over (partition by n_nationkey order by rule_order) as place
from nation, (values (0), (1)) r(rule_order)
""")
def read_rules_in_order(spark, data):
    """Rules of each network in the order a read returns them."""
    store = stored(spark, data, L3_FIREWALL_RULE, rules(spark, data))
    order = [F.asc_nulls_last(c) for c in L3_FIREWALL_RULE.sort]
    place = F.row_number().over(Window.partitionBy("network_id").orderBy(*order)).cast("bigint").alias("place")
    return read(L3_FIREWALL_RULE, store, ordered=False).select("network_id", "rule_order", place)


@query("""
select 'N' || n_nationkey as network_id, case when n_regionkey = 0 then 'enabled' else 'disabled' end as mode,
  '[{"url":"' || lower(n_name) || '"}]' as allowed_urls from nation
""")
def landed_malware(spark, data):
    rows = snapshot(spark, APPLIANCE_MALWARE, landed(spark, "malware", malware(spark, data)))
    return rows.select("network_id", "mode", "allowed_urls")


@query("""
select 'N' || s_nationkey as network_id, count(*) as ssids, count(*) filter (s_acctbal > 0) as enabled, false as shows_secret
from supplier group by all
""")
def sql_over_bucketed_views(spark, data):
    """Ad-hoc SQL over a table of several buckets; its secrets are not in the view."""
    root = new_folder(spark, "tables")
    HistoryStore.of(spark, root, SSID, buckets=4).merge(snapshot(spark, SSID, landed(spark, "ssid", ssids(spark, data))), T0)
    register_views(spark, root)
    shows = "psk" in spark.table("ssid").columns
    return spark.sql(f"""
        select network_id, count(*) as ssids, count_if(enabled) as enabled, {str(shows).lower()} as shows_secret
        from ssid where active_to is null group by network_id""")


@query("""
select 'N' || n_nationkey as network_id, 'S' || l_suppkey as serial, 'wan1' as interface, year(l_shipdate)::int as year,
  month(l_shipdate)::int as month, sum(l_quantity::bigint)::bigint as sent, sum(l_linenumber::bigint)::bigint as received
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
where l_shipdate >= timestamp '1998-05-01' and l_shipdate < timestamp '1998-05-11 12:00:00' group by all
""")
def refresh_usage_network_leaves(spark, data):
    """Usage refreshed, then again with every other network gone: no reading counts twice.

    No reading lies between the two, so the second refresh has nothing to add.
    """
    tables = new_folder(spark, "tables")
    for step, now in enumerate(("1998-05-11 12:00:00", "1998-05-11 12:00:01")):
        root = new_folder(spark, "landing")
        for spec in (ORGANIZATION, UPLINK_USAGE):
            LANDINGS[spec](spark, data).write.json(f"{root}/{spec.name}")
        here = networks(spark, data)
        if step:
            here = here.where(F.substring("id", -1, 1).cast("int") % 2 == 0)
        here.write.json(f"{root}/network")
        refresh(spark, root, tables, now, ["uplink_usage"])
    rows = open_store(spark, tables, UPLINK_USAGE).rows()
    return rows.select("network_id", "serial", "interface", "year", "month", "sent", "received")


@query("""
select 'N' || n_nationkey as network_id, 'S' || l_suppkey as serial, sum(l_quantity::bigint)::bigint as sent
from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
where l_shipdate >= timestamp '1998-05-01' and l_shipdate < timestamp '1998-05-11' and n_nationkey = 3 group by all
""")
def read_usage(spark, data):
    """Stored counters of a month, by network: other months' files are not read."""
    tables, root = new_folder(spark, "tables"), new_folder(spark, "landing")
    for spec in (ORGANIZATION, NETWORK, UPLINK_USAGE):
        LANDINGS[spec](spark, data).write.json(f"{root}/{spec.name}")
    refresh(spark, root, tables, "1998-05-11", ["uplink_usage"])
    store = open_store(spark, tables, UPLINK_USAGE)
    return read(UPLINK_USAGE, store, month=5, year=1998, network_id="N3").select("network_id", "serial", "sent")


@query("""
select 'N' || n_nationkey as network_id, rule_order, row_number() over (partition by n_nationkey order by rule_order) as place
from nation, (values (0), (1)) r(rule_order)
""")
def read_rules_in_order(spark, data):
    """Rules of each network in the order a read returns them."""
    store = stored(spark, data, L3_FIREWALL_RULE, rules(spark, data))
    nets = [r["network_id"] for r in store.open_rows().select("network_id").distinct().collect()]
    rows = []
    for net in sorted(nets):
        found = read(L3_FIREWALL_RULE, store, network_id=net).select("rule_order").collect()
        rows += [(net, r["rule_order"], place) for place, r in enumerate(found, 1)]
    return spark.createDataFrame(rows, "network_id string, rule_order int, place bigint")


@query("""
select 'N' || n_nationkey as network_id, case when n_regionkey = 0 then 'block' else 'allow' end as default_policy
from nation where n_nationkey = 7
""")
def read_one_policy(spark, data):
    """The single object of one network."""
    store = stored(spark, data, DHCP_SERVER_POLICY, policies(spark, data))
    return read(DHCP_SERVER_POLICY, store, network_id="N7").select("network_id", "default_policy")


@query("""
select 'N' || s_nationkey as network_id, s_suppkey::int as vlan_id, s_name as name from supplier
""")
def evolve_empty_table(spark, data):
    """A table made before its first rows takes them as any other."""
    schema = empty_table(spark, VLAN).schema
    store = HistoryStore(spark, new_folder(spark, "vlan"), VLAN.keys, schema, VLAN.json_cols)
    store.merge(empty_table(spark, VLAN), T0)
    store.merge(snapshot(spark, VLAN, landed(spark, "vlan", vlans(spark, data))), T1)
    return store.open_rows().select("network_id", "vlan_id", "name")


def land(spark, data, specs) -> str:
    root = new_folder(spark, "landing")
    for spec in specs:
        LANDINGS[spec](spark, data).write.json(f"{root}/{spec.name}")
    return root


def all_rows(spark, tables, specs):
    """How many rows each resource has in store."""
    counts = [(s.name, open_store(spark, tables, s).history().count()) for s in specs]
    return spark.createDataFrame(counts, "resource string, stored bigint")


@query("""
select 'organization' as resource, 0::bigint as stored union all select 'network', count(*) from nation
union all select 'vlan', count(*) from supplier join nation on n_nationkey = s_nationkey where n_regionkey in (0, 2)
union all select 'ssid', 0
""")
def refresh_selected(spark, data):
    """Only the resources asked for are stored, each after what it depends on."""
    tables = new_folder(spark, "tables")
    specs = [ORGANIZATION, NETWORK, VLAN, SSID]
    refresh(spark, land(spark, data, specs), tables, "2024-01-01", ["vlan", "network"])
    return all_rows(spark, tables, specs)


@query("""
select 'organization' as resource, count(*) as stored from region union all select 'network', count(*) from nation
union all select 'vlan', 0
""")
def refresh_empty_pull(spark, data):
    """An empty feed, an absent one, and a pull without organizations leave what is stored."""
    tables = new_folder(spark, "tables")
    specs = [ORGANIZATION, NETWORK, VLAN]
    refresh(spark, land(spark, data, [ORGANIZATION, NETWORK]), tables, "2024-01-01")
    later = land(spark, data, [ORGANIZATION])
    networks(spark, data).limit(0).write.json(f"{later}/network")
    refresh(spark, later, tables, "2024-01-02", ["network", "vlan"])
    refresh(spark, land(spark, data, [NETWORK]), tables, "2024-01-03")
    # A refresh repeated with the time of the last one changes nothing either.
    refresh(spark, land(spark, data, [ORGANIZATION, NETWORK]), tables, "2024-01-01", ["organization"])
    return all_rows(spark, tables, specs)


JSONS = ResourceSpec(
    name="scalar",
    keys=("id",),
    fields=(Field("id", "int", required=True), Field("amount", "json"), Field("flag", "json"), Field("tags", "array")),
    path="/scalars/{id}",
)


@query("""
select c_custkey::int as id, case when c_nationkey <> 3 then c_nationkey::varchar end as amount,
  case when c_acctbal > 0 then 'true' else 'false' end as flag, 'x,' || c_nationkey as tags from customer
""")
def normalize_json_scalars(spark, data):
    """Numbers and truth values in JSON columns, and array text that parses."""
    raw = table(spark, data, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("amount"),
        (F.col("c_acctbal") > 0).alias("flag"),
        F.format_string('["x","%s"]', F.col("c_nationkey").cast("string")).alias("tags"),
    )
    return normalize(raw, JSONS).withColumn("tags", F.array_join("tags", ","))


@query("""
select unnest(['log without time', 'array text', 'required name', 'month of versions', 'version of counters', 'unknown filter',
  'missing columns', 'partition outside the key', 'history after its time', 'null key']) as "case", true as refused
""")
def refused_cases(spark, data):
    """What must fail, over the shared tables: each case and whether it was refused."""
    customer = table(spark, data, "customer")
    events = table(spark, data, "events")
    nets = normalize(networks(spark, data), NETWORK)
    counters = T.StructType.fromDDL("k int, month int, n bigint, last_seen timestamp")
    base = opened(first_snapshot(spark, data), T0)
    folder = new_folder(spark, "refused")

    def store():
        return HistoryStore(spark, folder, CUSTOMER_KEYS, base.schema)

    untimed = events.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts")))
    texts = customer.select(F.col("c_custkey").cast("int").alias("id"), F.lit("[1").alias("tags"))
    cases = {
        "log without time": lambda: history_from_log(untimed, ["user_id"], ["event_type"], "ts", ["event_id"]).collect(),
        "array text": lambda: normalize(texts, JSONS).collect(),
        "required name": lambda: normalize(networks(spark, data).withColumn("name", F.lit(None).cast("string")), NETWORK).collect(),
        "month of versions": lambda: read(NETWORK, nets, month=1),
        "version of counters": lambda: read(UPLINK_USAGE, customer, "2024-01-01"),
        "unknown filter": lambda: read(NETWORK, nets, serial="x"),
        "missing columns": lambda: store().merge(customer.select("c_custkey"), T1),
        "partition outside the key": lambda: KeyedStore(spark, folder, ["k"], counters, ["month"]),
        "history after its time": lambda: store().load(base, "2020-01-01"),
        "null key": lambda: store().merge(first_snapshot(spark, data).withColumn("c_custkey", F.lit(None).cast("bigint")), T1),
    }
    rows = []
    for name, run in cases.items():
        try:
            run()
            rows.append((name, False))
        except Exception:
            rows.append((name, True))
    return spark.createDataFrame(rows, "case string, refused boolean")
