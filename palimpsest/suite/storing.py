"""Stored tables over time: rows that come late, many commits, and columns that change."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.evolve import Add, Cast, Drop, Rename
from palimpsest.operators.history import history_from_log
from palimpsest.session import step_path
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.suite.merging import CUSTOMER_KEYS, CUSTOMER_MERGE, EVENT_SCHEMA, T0, T1, first_snapshot, opened, second_snapshot
from palimpsest.suite.registry import new_folder, query, table
from palimpsest.suite.versions import EVENT_HISTORY

EVENT = (["user_id"], ["event_type"], "ts", ["event_id"])


def _day(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query(EVENT_HISTORY + "select * from h")
def store_merge_late(spark, data):
    """A loaded table, two log batches, and then a fifth of the events that came too late for all three."""
    events = table(spark, data, "events").select("user_id", "ts", "event_id", "event_type")
    late = (F.col("event_id") % 5 == 3) & (F.col("ts") < _day("2024-01-20"))
    log = events.where(~late)
    first, second = F.col("ts") < _day("2024-01-10"), F.col("ts") < _day("2024-01-20")
    store = HistoryStore(spark, new_folder(spark, "events"), ["user_id"], EVENT_SCHEMA, buckets=4)
    store.load(history_from_log(log.where(first), *EVENT), "2024-01-10")
    store.merge_log(log.where(~first & second), "ts", ["event_id"])
    store.merge_log(log.where(~second), "ts", ["event_id"])
    store.merge_late(events.where(late), "ts", ["event_id"], log)
    return store.history()


@query("""
with seen as (
  select c_custkey, c_mktsegment, timestamp '2024-01-01' as t, 1 as o from customer
  union all select c_custkey, 'LATE', timestamp '2024-01-15', 2 from customer where c_acctbal < 0
  union all select c_custkey, case when c_acctbal < 5000 then 'MOVED' else c_mktsegment end, timestamp '2024-02-01', 3 from customer),
x as (select *, case when lag(c_mktsegment) over w is distinct from c_mktsegment then 1 else 0 end as chg from seen window w as (partition by c_custkey order by t)),
y as (select *, sum(chg) over (partition by c_custkey order by t rows unbounded preceding) as g from x),
z as (select c_custkey, g, min(c_mktsegment) as c_mktsegment, min(t) as active_from, max(t) as last_seen from y group by all)
select c_custkey, c_mktsegment, active_from, lead(active_from) over (partition by c_custkey order by active_from) as active_to, last_seen from z
""")
def store_merge_late_snapshot(spark, data):
    """Two snapshots, and then one from between them for some of the customers; no log is kept."""
    customers = table(spark, data, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    schema = T.StructType.fromDDL(
        "c_custkey bigint, c_mktsegment string, active_from timestamp_ntz, active_to timestamp_ntz, last_seen timestamp_ntz"
    )
    store = HistoryStore(spark, new_folder(spark, "customers"), CUSTOMER_KEYS, schema, buckets=4)
    store.merge(customers, "2024-01-01")
    moved = F.when(F.col("c_acctbal") < 5000, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    store.merge(customers.withColumn("c_mktsegment", moved), "2024-02-01")
    late = customers.where(F.col("c_acctbal") < 0).select("c_custkey", F.lit("LATE").alias("c_mktsegment"), _day("2024-01-15").alias("t"))
    store.merge_late(late, "t")
    return store.history()


@query(EVENT_HISTORY + """
select t.ts as at, h.* from h join (values (timestamp '2024-01-05'), (timestamp '2024-01-13 12:00:00'), (timestamp '2024-02-01')) t(ts)
  on h.active_from <= t.ts and (h.active_to > t.ts or h.active_to is null)
""")
def store_as_of_after_compaction(spark, data):
    """Reads as of three times from a table whose nine commits were compacted in tiers of three."""
    events = table(spark, data, "events").select("user_id", "ts", "event_id", "event_type")
    store = HistoryStore(spark, new_folder(spark, "events"), ["user_id"], EVENT_SCHEMA, buckets=2, fanout=3)
    # Written once by batch: a merge reads its own rows several times, and no others.
    path = step_path(spark)
    day = F.dayofmonth("ts")
    batch = F.when(day >= 28, 9).otherwise(F.floor((day - 1) / 3)).cast("int")
    events.withColumn("_batch", batch).write.partitionBy("_batch").parquet(path)
    batches = spark.read.schema(events.withColumn("_batch", batch).schema).parquet(path)
    for k in range(10):
        store.merge_log(batches.where(F.col("_batch") == k).drop("_batch"), "ts", ["event_id"])
    out = None
    for ts in ("2024-01-05 00:00:00", "2024-01-13 12:00:00", "2024-02-01 00:00:00"):
        rows = store.at(ts).select(_day(ts).alias("at"), *EVENT_SCHEMA.names)
        out = rows if out is None else out.union(rows)
    return out


@query(CUSTOMER_MERGE + """
select c_custkey, c_nationkey::varchar as c_nationkey, c_mktsegment as segment, null::varchar as note, active_from, active_to, last_seen from m
""")
def store_evolved(spark, data):
    """Columns renamed, cast, added and dropped between two snapshots; the first one's files stay as they are."""
    schema = opened(first_snapshot(spark, data), T0).schema
    store = HistoryStore(spark, new_folder(spark, "customers"), CUSTOMER_KEYS, schema, buckets=4)
    store.merge(first_snapshot(spark, data), T0)
    steps = [Rename("c_mktsegment", "segment"), Cast("c_nationkey", "string", "int"), Add("note"), Drop("c_name")]
    store = store.evolve(*steps)
    batch = second_snapshot(spark, data).withColumnRenamed("c_mktsegment", "segment").withColumn("note", F.lit(None).cast("string"))
    store.merge(batch.drop("c_name"), T1)
    return store.history()


@query("""
select o_custkey as customer, year(o_orderdate)::int as year, month(o_orderdate)::int as month, count(*)::varchar as n,
  max(o_orderdate) as last_seen from orders group by all
""")
def store_keyed_evolved(spark, data):
    """A keyed table whose key column was renamed and whose count became text between two commits."""
    orders = table(spark, data, "orders")
    schema = T.StructType.fromDDL("o_custkey bigint, year int, month int, orders bigint, last_seen timestamp_ntz")
    monthly = orders.groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_seen"))
    even = F.col("month") % 2 == 0
    store = KeyedStore(spark, new_folder(spark, "monthly"), ["o_custkey", "year", "month"], schema, ["year"])
    store.upsert(monthly.where(even), "2002-01-01")
    store = store.evolve(Rename("o_custkey", "customer"), Rename("orders", "n"), Cast("n", "string", "bigint"))
    rest = monthly.where(~even).withColumnsRenamed({"o_custkey": "customer", "orders": "n"})
    store.upsert(rest.withColumn("n", F.col("n").cast("string")), "2002-01-02")
    return store.rows()
