"""Merges of snapshots and logs, and the tables they are committed to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.convert import explode_children
from palimpsest.operators.history import history_from_log
from palimpsest.operators.merge import (
    keyed_upsert,
    latest,
    rebuild_late,
    outcome_counts,
    scd2_merge,
)
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.streaming.ingest import stream_log
from palimpsest.suite.registry import new_folder, query, table
from palimpsest.suite.versions import EVENT_HISTORY

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"

CUSTOMER_KEYS = ["c_custkey"]
CUSTOMER_VALUES = ["c_name", "c_nationkey", "c_mktsegment"]

# A second snapshot of the customers: one segment is missing from it, customers in debt
# moved to another segment, and rich customers have a second account.
CUSTOMER_BATCH = """
  select c_custkey, c_name, c_nationkey,
    case when c_acctbal < 0 then 'REVIEW' else c_mktsegment end as c_mktsegment
  from customer where c_mktsegment <> 'FURNITURE'
  union all
  select c_custkey + 1000000000, c_name, c_nationkey, c_mktsegment from customer where c_acctbal > 9000
"""

CUSTOMER_MERGE = f"""
with o as (select c_custkey, c_name, c_nationkey, c_mktsegment from customer),
b as ({CUSTOMER_BATCH}),
j as (
  select o.c_custkey as ok, b.c_custkey as bk, o.c_name as oname, b.c_name as bname,
    o.c_nationkey as onat, b.c_nationkey as bnat, o.c_mktsegment as oseg, b.c_mktsegment as bseg,
    (o.c_name, o.c_nationkey, o.c_mktsegment) is not distinct from
      (b.c_name, b.c_nationkey, b.c_mktsegment) as same
  from o full join b on o.c_custkey = b.c_custkey),
m as (
  select bk as c_custkey, bname as c_name, bnat as c_nationkey, bseg as c_mktsegment,
    timestamp '{T1}' as active_from, null::timestamp as active_to, timestamp '{T1}' as last_seen,
    'open' as _part, 'inserted' as _outcome from j where ok is null
  union all
  select ok, oname, onat, oseg, timestamp '{T0}', null, timestamp '{T0}', 'open', null
  from j where bk is null
  union all
  select ok, oname, onat, oseg, timestamp '{T0}', null, timestamp '{T1}', 'open', 'updated'
  from j where ok is not null and bk is not null and same
  union all
  select bk, bname, bnat, bseg, timestamp '{T1}', null, timestamp '{T1}', 'open', 'expired+inserted'
  from j where ok is not null and bk is not null and not same
  union all
  select ok, oname, onat, oseg, timestamp '{T0}', timestamp '{T1}', timestamp '{T0}', 'closed', null
  from j where ok is not null and bk is not null and not same)
"""


def first_snapshot(spark, data) -> DataFrame:
    return table(spark, data, "customer").select(*CUSTOMER_KEYS, *CUSTOMER_VALUES)


def second_snapshot(spark, data) -> DataFrame:
    customers = table(spark, data, "customer")
    moved = F.when(F.col("c_acctbal") < 0, "REVIEW").otherwise(F.col("c_mktsegment"))
    seen = customers.where(F.col("c_mktsegment") != "FURNITURE").withColumn("c_mktsegment", moved)
    added = customers.where(F.col("c_acctbal") > 9000).withColumn(
        "c_custkey", F.col("c_custkey") + 1_000_000_000
    )
    return seen.unionByName(added).select(*CUSTOMER_KEYS, *CUSTOMER_VALUES)


def opened(df: DataFrame, ts: str) -> DataFrame:
    """Rows as open versions since `ts`."""
    t = F.lit(ts).cast("timestamp_ntz")
    return df.withColumns(
        {"active_from": t, "active_to": F.lit(None).cast("timestamp_ntz"), "last_seen": t}
    )


def customer_merge(spark, data, **options):
    return scd2_merge(
        opened(first_snapshot(spark, data), T0),
        second_snapshot(spark, data),
        CUSTOMER_KEYS,
        CUSTOMER_VALUES,
        T1,
        **options,
    )


@query(CUSTOMER_MERGE + "select * from m")
def scd2_merge_customer(spark, data):
    return customer_merge(spark, data)


@query(CUSTOMER_MERGE + "select * from m")
def scd2_merge_small_batch(spark, data):
    """The same with the plan for a batch far smaller than the open rows."""
    return customer_merge(spark, data, small_batch=True)


@query(CUSTOMER_MERGE + """
select o.outcome, count(m._outcome) as rows
from (values ('inserted'), ('updated'), ('expired+inserted')) o(outcome)
left join m on m._outcome = o.outcome group by o.outcome
""")
def scd2_outcome_counts(spark, data):
    return outcome_counts(customer_merge(spark, data))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate from (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc) as n
  from lineitem) where n = 1
""")
def dedup_batch(spark, data):
    """Repeats of a key within one batch: the last wins."""
    lines = table(spark, data, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return latest(lines, ["l_orderkey", "l_linenumber"], order)


@query(f"""
with b as (
  select l_suppkey as s_suppkey, 'Ships ' || max(l_shipdate)::date::varchar as s_name,
    max(l_linenumber) as s_nationkey, max(l_shipdate) as seen
  from lineitem group by l_suppkey),
b2 as (select s_suppkey, s_name, s_nationkey,
    case when s_nationkey > 5 then seen else timestamp '{T1}' end as last_seen from b)
select s_suppkey, s_name, s_nationkey, timestamp '{T0}' as last_seen from supplier s
where not exists (select 1 from b2 where b2.s_suppkey = s.s_suppkey)
union all select * from b2
""")
def keyed_upsert_supplier(spark, data):
    """Suppliers overwritten from their shipments; `last_seen` is given for some of them."""
    base = table(spark, data, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.lit(T0).cast("timestamp_ntz").alias("last_seen")
    )
    batch = table(spark, data, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.concat(F.lit("Ships "), F.max("l_shipdate").cast("date").cast("string")).alias("s_name"),
        F.max("l_linenumber").alias("s_nationkey"),
        F.max("l_shipdate").alias("_seen"),
    )
    batch = batch.withColumn("last_seen", F.when(F.col("s_nationkey") > 5, F.col("_seen"))).drop("_seen")
    return keyed_upsert(base, batch, ["s_suppkey"], T1)


RULES = "[c_mktsegment, c_name, cast(c_nationkey as varchar)]"


@query(f"""
with lists as (
  select c_custkey, {RULES} as old,
    case when c_acctbal < 0 then [c_name, c_mktsegment]
         when c_acctbal > 5000 then list_reverse({RULES}) else {RULES} end as new from customer),
o as (select c_custkey, unnest(old) as rule, unnest(range(len(old))) as rule_order from lists),
b as (select c_custkey, unnest(new) as rule, unnest(range(len(new))) as rule_order from lists)
select o.c_custkey, o.rule_order::int as rule_order,
  case when b.rule is null then 'left open' when b.rule = o.rule then 'updated'
       else 'expired+inserted' end as result, coalesce(b.rule, o.rule) as rule
from o left join b on b.c_custkey = o.c_custkey and b.rule_order = o.rule_order
""")
def positional_merge(spark, data):
    """Lists of rules keyed by position: reordering replaces the moved positions, and the tail
    of a list that became shorter stays open."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    rules = F.array(segment, name, F.col("c_nationkey").cast("string"))
    new = (
        F.when(F.col("c_acctbal") < 0, F.array(name, segment))
        .when(F.col("c_acctbal") > 5000, F.reverse(rules))
        .otherwise(rules)
    )

    def positions(items):
        wrapped = F.transform(items, lambda r: F.struct(r.alias("rule")))
        lists = table(spark, data, "customer").select("c_custkey", wrapped.alias("rules"))
        return explode_children(lists, "rules", ["c_custkey"], "rule_order")

    merged = scd2_merge(
        opened(positions(rules), T0), positions(new), ["c_custkey", "rule_order"], ["rule"], T1
    )
    return merged.where(F.col("_part") == "open").select(
        "c_custkey", "rule_order", F.coalesce("_outcome", F.lit("left open")).alias("result"), "rule"
    )


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("active_from", T.TimestampNTZType()),
        T.StructField("active_to", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
    ]
)
# Uneven cuts of the log.
CUTS = ["2024-01-03", "2024-01-17 06:30:00", "2024-01-18"]


def event_parts(spark, data) -> list[DataFrame]:
    events = table(spark, data, "events").select("user_id", "ts", "event_id", "event_type")
    times = [F.lit(c).cast("timestamp_ntz") for c in CUTS]
    bounds = [None, *times, None]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        keep = F.lit(True)
        keep = keep if low is None else keep & (F.col("ts") >= low)
        keep = keep if high is None else keep & (F.col("ts") < high)
        parts.append(events.where(keep))
    return parts


@query(EVENT_HISTORY + "select * from h")
def store_merge_log(spark, data):
    """Four batches of a log committed one after the other equal one pass over the log."""
    store = HistoryStore(spark, new_folder(spark, "events"), ["user_id"], EVENT_SCHEMA)
    for part in event_parts(spark, data):
        store.merge_log(part, "ts", ["event_id"])
    return store.history()


@query(EVENT_HISTORY + """
select * from h where active_from <= timestamp '2024-01-10'
  and (active_to > timestamp '2024-01-10' or active_to is null)
""")
def store_as_of(spark, data):
    """A stored history read as of a time: earlier commits' closed rows are not read."""
    store = HistoryStore(spark, new_folder(spark, "events"), ["user_id"], EVENT_SCHEMA)
    for part in event_parts(spark, data):
        store.merge_log(part, "ts", ["event_id"])
    return store.at("2024-01-10")


@query(EVENT_HISTORY + "select * from h")
def stream_merge_log(spark, data):
    """The same batches landed as files and taken up by a stream, run once per landing."""
    landing = new_folder(spark, "landing")
    store = HistoryStore(spark, new_folder(spark, "stream"), ["user_id"], EVENT_SCHEMA)
    for part in event_parts(spark, data):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(part.schema).parquet(landing)
        stream_log(stream, store, "ts", ["event_id"]).awaitTermination()
    return store.history()


@query(EVENT_HISTORY + "select * from h")
def late_events_rebuild(spark, data):
    """Errors that arrive after everything else: only their users are rebuilt."""
    events = table(spark, data, "events").select("user_id", "ts", "event_id", "event_type")
    late = (F.col("event_type") == "error") & (F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    log = events.where(~late)
    names = (["user_id"], ["event_type"], "ts", ["event_id"])
    return rebuild_late(history_from_log(log, *names), log, events.where(late), *names)


@query(CUSTOMER_MERGE + """
select c_custkey, c_name, c_nationkey, c_mktsegment, active_from, active_to,
  case when _part = 'open' and c_mktsegment <> 'REVIEW' then timestamp '2024-03-01' else last_seen end as last_seen
from m
""")
def store_merge_snapshots(spark, data):
    """Three snapshots committed to a table; the third repeats what is open, without one segment."""
    schema = opened(first_snapshot(spark, data), T0).schema
    folder = new_folder(spark, "customers")
    store = HistoryStore(spark, folder, CUSTOMER_KEYS, schema, buckets=8)
    store.merge(first_snapshot(spark, data), T0)
    store.merge(second_snapshot(spark, data), T1, small_bytes=0)
    store.merge(store.open_rows().where(F.col("c_mktsegment") != "REVIEW"), T2)
    return store.history()


@query("""
with s as (select o_custkey, year(o_orderdate) as year, month(o_orderdate) as month,
    count(*)::bigint as orders, max(o_orderdate) as last_seen from orders
    where o_orderdate < timestamp '2001-06-15' group by 1, 2, 3),
n as (select o_custkey, year(o_orderdate) as year, month(o_orderdate) as month,
    -count(*)::bigint as orders, max(o_orderdate) as last_seen from orders
    where o_orderdate >= timestamp '2001-06-15' group by 1, 2, 3)
select o_custkey, year::int as year, month::int as month, orders, last_seen from s
where not exists (select 1 from n where n.o_custkey = s.o_custkey and n.year = s.year and n.month = s.month)
union all select o_custkey, year::int, month::int, orders, last_seen from n
""")
def store_keyed_upsert(spark, data):
    """A keyed table by month: the second commit rewrites only the months it touches."""
    orders = table(spark, data, "orders")
    schema = T.StructType.fromDDL(
        "o_custkey bigint, year int, month int, orders bigint, last_seen timestamp_ntz"
    )

    def monthly(part, sign):
        return part.groupBy(
            "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
        ).agg((F.count(F.lit(1)) * sign).alias("orders"), F.max("o_orderdate").alias("last_seen"))

    cut = F.lit("2001-06-15").cast("timestamp_ntz")
    keys = ["o_custkey", "year", "month"]
    store = KeyedStore(spark, new_folder(spark, "orders"), keys, schema, ["year", "month"])
    store.upsert(monthly(orders.where(F.col("o_orderdate") < cut), 1), T0)
    store.upsert(monthly(orders.where(F.col("o_orderdate") >= cut), -1), T1)
    return store.rows()
