"""Records that do not convert, events that come twice, and tables as of a time in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.rejects import accepted, checked, read_lenient, rejected
from palimpsest.resources import NETWORK, VLAN
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.sources.views import register_functions
from palimpsest.streaming.ingest import stream_counters
from palimpsest.suite.counting import COUNTER_KEYS
from palimpsest.suite.registry import new_folder, query, table

# Orders as VLAN records: some without a network, with a name for an id, a mask that is too large, or cut off in the middle.
FAULTS = """
with r as (
  select o_orderkey as k, o_custkey as c,
    case when o_orderkey % 11 = 0 then 'cut' else 'whole' end as kind,
    case when o_orderkey % 7 = 0 then null else 'N' || o_custkey end as network_id,
    case when o_orderkey % 5 = 0 then 'vlan' || o_orderkey else o_orderkey::varchar end as id,
    case when o_orderkey % 13 = 0 then '99999999999' else (o_orderkey % 33)::varchar end as mask
  from orders)
"""


def vlan_records(spark, data):
    """A folder of JSON lines, one for each order."""
    orders, key = table(spark, data, "orders"), F.col("o_orderkey")
    network = F.when(key % 7 != 0, F.concat(F.lit("N"), F.col("o_custkey").cast("string")))
    number = F.when(key % 5 == 0, F.concat(F.lit('"vlan'), key.cast("string"), F.lit('"'))).otherwise(key.cast("string"))
    mask = F.when(key % 13 == 0, F.lit("99999999999")).otherwise((key % 33).cast("string"))
    field = F.coalesce(F.concat(F.lit('"networkId":"'), network, F.lit('",')), F.lit(""))
    line = F.concat(F.lit("{"), field, F.lit('"name":"v","id":'), number, F.lit(',"mask":'), mask, F.lit("}"))
    folder = new_folder(spark, "vlans")
    orders.select(F.when(key % 11 == 0, F.expr("concat('{\"id\":', o_orderkey, ',')")).otherwise(line).alias("value")).write.text(folder)
    return folder


@query(FAULTS + """
select 'accepted' as part, network_id, id as vlan_id, mask, null::varchar as reason from r
where kind = 'whole' and k % 7 <> 0 and k % 5 <> 0 and k % 13 <> 0
union all select 'network_id', null, null, null, 'missing' from r where kind = 'whole' and k % 7 = 0
union all select 'vlan_id', null, id, null, 'does not fit int' from r where kind = 'whole' and k % 5 = 0
union all select 'mask', null, null, mask, 'does not fit int' from r where kind = 'whole' and k % 13 = 0
union all select 'record', null, null, null, 'unreadable' from r where kind = 'cut'
""")
def records_and_rejects(spark, data):
    """Landed records that convert, and every fault of the others with its reason."""
    rows = checked(read_lenient(spark, vlan_records(spark, data), VLAN), VLAN)
    good = accepted(rows).select(
        F.lit("accepted").alias("part"), "network_id", F.col("vlan_id").cast("string").alias("vlan_id"),
        F.col("mask").cast("string").alias("mask"), F.lit(None).cast("string").alias("reason"),
    )
    none = F.lit(None).cast("string")
    of = lambda name: F.when(F.col("field") == name, F.col("value"))
    bad = rejected(rows).select(F.coalesce("field", F.lit("record")), none, of("vlan_id"), of("mask"), "reason")
    return good.union(bad)


@query("""
select user_id as l_suppkey, year(ts)::int as year, month(ts)::int as month, sum(event_id % 100)::bigint as quantity from events group by all
""")
def stream_counters_once(spark, data):
    """A stream that delivers its events, half of them again in the same batch, and all of them again later: each counts once."""
    events = table(spark, data, "events").select(
        "event_id", F.col("user_id").alias("l_suppkey"), (F.col("event_id") % 100).alias("quantity"), "ts"
    )
    landing = new_folder(spark, "landing")
    schema = T.StructType.fromDDL("l_suppkey bigint, year int, month int, quantity bigint, last_seen timestamp")
    store = KeyedStore(spark, new_folder(spark, "counters"), COUNTER_KEYS, schema, ["year", "month"])
    for part in (events.unionAll(events.where("event_id % 2 = 0")), events):
        part.coalesce(4).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        stream_counters(stream, store, ["quantity"], "ts", "2024-01-30", once_by=["event_id"]).awaitTermination()
    return store.rows().select("l_suppkey", "year", "month", "quantity")


@query("""
select 'N' || c_custkey as id, case when c_acctbal < 0 then 'poor' else c_mktsegment end as name, 'before' as at from customer where c_custkey % 3 = 0
union all
select 'N' || c_custkey, case when c_acctbal < 0 then 'rich' else c_mktsegment end, 'after' from customer where c_custkey % 3 = 0
""")
def sql_as_of(spark, data):
    """A table as of two times, by a function in SQL with a filter on its rows."""
    root = new_folder(spark, "tables")
    store = HistoryStore.of(spark, root, NETWORK, buckets=2)
    customers = table(spark, data, "customer")

    def networks(poor):
        given = {
            "id": F.concat(F.lit("N"), F.col("c_custkey").cast("string")),
            "organization_id": F.concat(F.lit("O"), (F.col("c_custkey") % 3).cast("string")),
            "name": F.when(F.col("c_acctbal") < 0, F.lit(poor)).otherwise(F.col("c_mktsegment")),
        }
        empty = {f.name: F.lit(None).cast(f.dtype) for f in NETWORK.fields if f.name not in given}
        return customers.select(*[c.alias(n) for n, c in (given | empty).items()])

    store.merge(networks("poor"), "2026-01-01")
    store.merge(networks("rich"), "2026-02-01")
    register_functions(spark, root, "sql_as_of_")
    out = None
    for at, ts in (("before", "2026-01-15"), ("after", "2026-02-15")):
        rows = spark.sql(f"select id, name, '{at}' as at from sql_as_of_network_at(timestamp '{ts} 00:00:00') where organization_id = 'O0'")
        out = rows if out is None else out.union(rows)
    return out
