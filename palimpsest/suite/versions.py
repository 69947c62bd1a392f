"""History from a log, and reads over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators.diff import version_churn
from palimpsest.operators.history import (
    as_of,
    as_of_join,
    at_time,
    current,
    history_from_log,
    open_row_violations,
    stale,
)
from palimpsest.suite.registry import query, table

# Versions of each user's state, by another method: number the changes, then group the runs.
EVENT_HISTORY = """
with x as (
  select user_id, ts, event_id, event_type,
    case when row_number() over w = 1 or event_type is distinct from lag(event_type) over w
         then 1 else 0 end as chg
  from events window w as (partition by user_id order by ts, event_id)),
y as (
  select *, sum(chg) over (partition by user_id order by ts, event_id rows unbounded preceding) as g
  from x),
z as (
  select user_id, g, min(event_type) as event_type, min(ts) as active_from, max(ts) as last_seen
  from y group by user_id, g),
h as (
  select user_id, event_type, active_from,
    lead(active_from) over (partition by user_id order by active_from) as active_to, last_seen
  from z)
"""

# Versions of each customer's latest order state; several orders of one day count as the last.
ORDER_HISTORY = """
with daily as (
  select o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus from orders
  qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1),
x as (
  select *, case when row_number() over w = 1
      or o_orderpriority is distinct from lag(o_orderpriority) over w
      or o_orderstatus is distinct from lag(o_orderstatus) over w then 1 else 0 end as chg
  from daily window w as (partition by o_custkey order by o_orderdate)),
y as (
  select *, sum(chg) over (partition by o_custkey order by o_orderdate rows unbounded preceding) as g
  from x),
z as (
  select o_custkey, g, min(o_orderpriority) as o_orderpriority, min(o_orderstatus) as o_orderstatus,
    min(o_orderdate) as active_from, max(o_orderdate) as last_seen
  from y group by o_custkey, g),
h as (
  select o_custkey, o_orderpriority, o_orderstatus, active_from,
    lead(active_from) over (partition by o_custkey order by active_from) as active_to, last_seen
  from z)
"""


def event_history(spark, data):
    return history_from_log(
        table(spark, data, "events"), ["user_id"], ["event_type"], "ts", ["event_id"]
    )


def order_history(spark, data):
    return history_from_log(
        table(spark, data, "orders"),
        ["o_custkey"],
        ["o_orderpriority", "o_orderstatus"],
        "o_orderdate",
        ["o_orderkey"],
    )


@query(EVENT_HISTORY + """
select event_type, count(*) as users, min(active_from) as oldest, max(last_seen) as latest
from h where active_from <= timestamp '2024-01-15 12:00:00'
  and (active_to > timestamp '2024-01-15 12:00:00' or active_to is null)
group by event_type
""")
def state_counts(spark, data):
    """What state was every user in at a time?"""
    return (
        as_of(event_history(spark, data), "2024-01-15 12:00:00")
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.min("active_from").alias("oldest"),
            F.max("last_seen").alias("latest"),
        )
    )


@query(EVENT_HISTORY + "select * from h")
def history_from_event_log(spark, data):
    return event_history(spark, data)


@query(ORDER_HISTORY + "select * from h")
def history_from_order_log(spark, data):
    """Several columns, and ties within a key and time."""
    return order_history(spark, data)


@query(EVENT_HISTORY + "select * from h")
def history_with_hot_keys(spark, data):
    """The same history with every user treated as a hot key and cut into slices."""
    events = table(spark, data, "events")
    return history_from_log(
        events, ["user_id"], ["event_type"], "ts", ["event_id"], rows_per_slice=20
    )


@query(ORDER_HISTORY + "select * from h where active_to is null")
def current_rows(spark, data):
    return current(order_history(spark, data))


@query(ORDER_HISTORY + """
select * from h where active_from <= timestamp '1998-03-01'
  and (active_to > timestamp '1998-03-01' or active_to is null)
""")
def as_of_rows(spark, data):
    return as_of(order_history(spark, data), "1998-03-01")


@query(ORDER_HISTORY + """
select o_custkey, count(*) as versions, count(active_to) as closed, min(active_from) as first_from
from h group by o_custkey
""")
def all_versions(spark, data):
    return (
        at_time(order_history(spark, data), "all")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("versions"),
            F.count("active_to").alias("closed"),
            F.min("active_from").alias("first_from"),
        )
    )


@query(ORDER_HISTORY + """
select * from h where active_to is null and last_seen < timestamp '2001-08-01' - interval 180 day
""")
def stale_rows(spark, data):
    return stale(order_history(spark, data), "2001-08-01", "180 days")


@query("""
select l_orderkey, l_linenumber, count(*) as open_rows from lineitem
group by l_orderkey, l_linenumber having count(*) > 1
""")
def open_row_check(spark, data):
    """Lines taken as open rows without removing repeats: the check names every broken key."""
    rows = table(spark, data, "lineitem").withColumn("active_to", F.lit(None).cast("timestamp_ntz"))
    return open_row_violations(rows, ["l_orderkey", "l_linenumber"])


AS_OF_JOIN = ORDER_HISTORY + """
select s.o_custkey, s.l_orderkey, s.l_linenumber, s.l_quantity, s.l_shipdate, h.active_from,
  h.active_to, h.o_orderpriority, h.o_orderstatus
from (select o.o_custkey, l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_shipdate
      from lineitem l join orders o on o.o_orderkey = l.l_orderkey) s
{how} join h on h.o_custkey = s.o_custkey and h.active_from <= s.l_shipdate
  and (h.active_to > s.l_shipdate or h.active_to is null)
"""


def shipments(spark, data):
    orders = table(spark, data, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, data, "lineitem")
    return lines.join(orders, "l_orderkey").select(
        "o_custkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"
    )


@query(AS_OF_JOIN.format(how=""))
def as_of_join_shipments(spark, data):
    """Every shipment with the state its customer was in on the day."""
    return as_of_join(
        shipments(spark, data),
        order_history(spark, data),
        ["o_custkey"],
        "l_shipdate",
        ["o_orderpriority", "o_orderstatus"],
    )


@query(AS_OF_JOIN.format(how="left"))
def as_of_join_hot_keys(spark, data):
    """The same with every customer cut into slices, keeping shipments without a version."""
    return as_of_join(
        shipments(spark, data),
        order_history(spark, data),
        ["o_custkey"],
        "l_shipdate",
        ["o_orderpriority", "o_orderstatus"],
        how="left",
        rows_per_slice=25,
    )


@query(ORDER_HISTORY + """
, pairs as (
  select o_orderpriority as b1, o_orderstatus as b2,
    lag(o_orderpriority) over w as a1, lag(o_orderstatus) over w as a2, row_number() over w as n
  from h window w as (partition by o_custkey order by active_from))
select 'o_orderpriority' as field, count(*) as changes from pairs
where n > 1 and a1 is distinct from b1 having count(*) > 0
union all
select 'o_orderstatus', count(*) from pairs where n > 1 and a2 is distinct from b2 having count(*) > 0
""")
def churn_by_field(spark, data):
    """Which field causes how many new versions?"""
    return version_churn(
        order_history(spark, data), ["o_custkey"], ["o_orderpriority", "o_orderstatus"]
    )
