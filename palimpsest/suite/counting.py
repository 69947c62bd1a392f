"""Monthly counters, reading windows and the usage report."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.counters import (
    accumulate,
    for_month,
    in_windows,
    monthly_delta,
    plan_windows,
    read_month,
    split_late,
)
from palimpsest.plans.report import usage_report
from palimpsest.sources.store import KeyedStore
from palimpsest.streaming.ingest import stream_counters
from palimpsest.suite.registry import new_folder, query, table

NOW = "1998-07-10 06:00:00"
CUT = "1998-06-20 00:00:00"

COUNTER_KEYS = ["l_suppkey", "year", "month"]

STATE = f"""
state as (
  select l_suppkey, year(l_shipdate)::int as year, month(l_shipdate)::int as month,
    sum(l_quantity::bigint)::bigint as quantity, max(l_shipdate) + interval 1 day as last_seen
  from lineitem where l_shipdate < timestamp '{CUT}' group by 1, 2, 3)
"""

WINDOWS = f"""
seen as (select l_suppkey, max(last_seen) as seen from state group by 1),
windows as (
  select s_suppkey as l_suppkey, seen,
    greatest(coalesce(seen, timestamp '1998-07-01'), timestamp '{NOW}' - interval 30 day) as t0
  from supplier left join seen on l_suppkey = s_suppkey),
w as (
  select l_suppkey, t0, least(timestamp '{NOW}', t0 + interval 14 day) as t1,
    case when seen < timestamp '{NOW}' - interval 30 day then seen end as lost_from,
    case when seen < timestamp '{NOW}' - interval 30 day then timestamp '{NOW}' - interval 30 day end as lost_to
  from windows)
"""


def state(spark, data):
    lines = table(spark, data, "lineitem").where(F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"))
    return lines.groupBy(
        "l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    ).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        (F.max("l_shipdate") + F.expr("interval 1 day")).alias("last_seen"),
    )


def suppliers(spark, data):
    return table(spark, data, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))


def shipped(spark, data):
    return table(spark, data, "lineitem").select(
        "l_suppkey", "l_shipdate", F.col("l_quantity").cast("bigint").alias("quantity")
    )


@query(f"with {STATE}, {WINDOWS} select * from w")
def usage_windows(spark, data):
    """The next reading window of every supplier."""
    return plan_windows(suppliers(spark, data), state(spark, data), ["l_suppkey"], NOW)


@query("""
with last as (select o_custkey, max(o_orderdate) as seen from orders group by 1),
w as (select c_custkey as o_custkey, seen,
    greatest(coalesce(seen, timestamp '2001-08-01'), timestamp '2001-08-02' - interval 30 day) as t0
  from customer left join last on o_custkey = c_custkey)
select o_custkey, seen as lost_from, timestamp '2001-08-02' - interval 30 day as lost_to,
  date_diff('day', seen, timestamp '2001-08-02' - interval 30 day)::int as lost_days
from w where seen < timestamp '2001-08-02' - interval 30 day
""")
def usage_gaps(spark, data):
    """Customers whose reading stopped too long ago, with the range that cannot be read."""
    seen = table(spark, data, "orders").select("o_custkey", F.col("o_orderdate").alias("last_seen"))
    groups = table(spark, data, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return (
        plan_windows(groups, seen, ["o_custkey"], "2001-08-02")
        .where(F.col("lost_from").isNotNull())
        .select(
            "o_custkey",
            "lost_from",
            "lost_to",
            F.datediff("lost_to", "lost_from").alias("lost_days"),
        )
    )


@query(f"""
with {STATE}, {WINDOWS},
delta as (
  select l.l_suppkey, year(l_shipdate)::int as year, month(l_shipdate)::int as month,
    sum(l_quantity::bigint)::bigint as quantity, max(t1) as last_seen
  from lineitem l join w on w.l_suppkey = l.l_suppkey
  where l_shipdate >= t0 and l_shipdate < t1 group by 1, 2, 3)
select coalesce(d.l_suppkey, s.l_suppkey) as l_suppkey, coalesce(d.year, s.year) as year,
  coalesce(d.month, s.month) as month,
  case when d.l_suppkey is null then s.quantity
       else coalesce(s.quantity, 0) + coalesce(d.quantity, 0) end as quantity,
  coalesce(d.last_seen, s.last_seen) as last_seen
from state s full join delta d
  on d.l_suppkey = s.l_suppkey and d.year = s.year and d.month = s.month
""")
def usage_accumulate(spark, data):
    """Stored counters plus what each supplier shipped within its window."""
    held = state(spark, data)
    windows = plan_windows(suppliers(spark, data), held, ["l_suppkey"], NOW)
    events = in_windows(shipped(spark, data), windows, ["l_suppkey"], "l_shipdate")
    delta = monthly_delta(events, ["l_suppkey"], ["quantity"], "l_shipdate")
    return accumulate(held, delta, COUNTER_KEYS, ["quantity"])


@query(f"with {STATE} select * from state where year = 1998 and month = 3")
def counters_of_month(spark, data):
    return for_month(state(spark, data), "1998-03-15")


@query("""
select l_suppkey, year(l_shipdate)::int as year, month(l_shipdate)::int as month,
  sum(l_quantity::bigint)::bigint as quantity, timestamp '1998-07-10' + interval 14 day as last_seen
from lineitem where l_shipdate >= timestamp '1998-08-09' - interval 30 day
  and l_shipdate < timestamp '1998-07-10' + interval 14 day group by 1, 2, 3
""")
def usage_without_state(spark, data):
    """July read on August 9: from the lookback limit, over 14 days."""
    return read_month(
        shipped(spark, data), ["l_suppkey"], ["quantity"], "l_shipdate", "1998-08-09", month=7
    )


@query("""
select year(l_shipdate)::int as year, month(l_shipdate)::int as month,
  l_shipdate < timestamp '2001-11-05' - interval 30 day as late, count(*) as events
from lineitem group by 1, 2, 3
""")
def late_events(spark, data):
    """Events too old to be read, per month."""
    marked = split_late(table(spark, data, "lineitem"), "l_shipdate", "2001-11-05")
    return marked.groupBy(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "late"
    ).agg(F.count(F.lit(1)).alias("events"))


@query("""
select user_id, year(ts)::int as year, month(ts)::int as month, count(*) as events,
  sum(cast(json_extract(props, '$.k') as bigint))::bigint as total, max(ts) as last_seen
from events where ts >= timestamp '2024-02-05' - interval 30 day group by 1, 2, 3
""")
def stream_monthly_counters(spark, data):
    """Events landed in two loads and counted by a stream; what is too old is left out."""
    events = table(spark, data, "events").select(
        "user_id",
        "ts",
        F.lit(1).cast("bigint").alias("events"),
        F.get_json_object("props", "$.k").cast("bigint").alias("total"),
    )
    schema = T.StructType.fromDDL(
        "user_id bigint, month int, year int, events bigint, total bigint, last_seen timestamp_ntz"
    )
    landing = new_folder(spark, "landing")
    keys = ["user_id", "month", "year"]
    store = KeyedStore(spark, new_folder(spark, "counters"), keys, schema, ["year", "month"])
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    for part in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(part.schema).parquet(landing)
        stream_counters(stream, store, ["events", "total"], "ts", "2024-02-05").awaitTermination()
    return store.rows()


@query("""
with usage as (
  select c_nationkey, l_returnflag as interface, year(l_shipdate)::int as year,
    month(l_shipdate)::int as month,
    sum(l_quantity::bigint * 100000000)::bigint as sent,
    sum(l_linenumber::bigint * 100000000)::bigint as received
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
  group by 1, 2, 3, 4)
select n_name as network_name, interface as wan_interface, year, month,
  ((sent * 200 + 1073741824) // 2147483648) / 100.0 as sent_gb,
  ((received * 200 + 1073741824) // 2147483648) / 100.0 as received_gb,
  (((sent + received) * 200 + 1073741824) // 2147483648) / 100.0 as total_gb
from usage join nation on n_nationkey = c_nationkey where n_regionkey <> 3
""")
def usage_gb_report(spark, data):
    """Usage per nation, interface and month in gigabytes, for the nations that are current.

    The nations' history holds a closed earlier name for all, and no open row for one region.
    """
    nation = table(spark, data, "nation")
    t = F.lit("2000-01-01").cast("timestamp_ntz")
    earlier = nation.select(
        F.col("n_nationkey").alias("id"), F.concat(F.lit("OLD "), "n_name").alias("name"), t.alias("active_to")
    )
    now = nation.where(F.col("n_regionkey") != 3).select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit(None).cast("timestamp_ntz").alias("active_to")
    )
    lines = table(spark, data, "lineitem")
    orders = table(spark, data, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, data, "customer").select("c_custkey", F.col("c_nationkey").alias("network_id"))
    # Summed per order first: what crosses to the customers is one row per order, flag and month.
    per_order = lines.groupBy(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_returnflag").alias("interface"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    ).agg(
        F.sum(F.col("l_quantity").cast("bigint") * 100_000_000).alias("sent"),
        F.sum(F.col("l_linenumber").cast("bigint") * 100_000_000).alias("received"),
    )
    owner = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select("o_orderkey", "network_id")
    usage = (
        per_order.join(owner, "o_orderkey")
        .groupBy("network_id", "interface", "year", "month")
        .agg(F.sum("sent").alias("sent"), F.sum("received").alias("received"))
    )
    report = usage_report(usage, earlier.unionByName(now))
    return report.withColumns({c: F.col(c).cast("double") for c in ("sent_gb", "received_gb", "total_gb")})
