"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the threads. Every query runs whole,
into a sink that discards the rows; the first run of each warms up and does not count.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from palimpsest.operators.merge import scd2_merge
from palimpsest.session import session
from palimpsest.suite import QUERIES
from palimpsest.suite.merging import opened
from palimpsest.suite.registry import table

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "state_counts",
    "history_from_event_log",
    "history_from_order_log",
    "history_with_hot_keys",
    "as_of_rows",
    "as_of_join_shipments",
    "churn_by_field",
    "scd2_merge_customer",
    "scd2_merge_small_batch",
    "dedup_batch",
    "keyed_upsert_supplier",
    "usage_accumulate",
    "usage_gb_report",
    "tags_include_exclude",
    "normalize_children",
    "payloads",
    "json_equality",
    "enrich_uplink_provider",
    "range_lookup_bands",
    "route_by_product_type",
    "diff_fields",
    "update_action_records",
    "action_chunks",
    "evolve_upgrade",
    "store_merge_snapshots",
    "store_merge_log",
    "stream_merge_log",
]


def merge_orders(spark, data):
    """A snapshot of all orders in which a tenth changed, against the open rows."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    orders = table(spark, data, "orders").select(*columns)
    changed = F.when(F.col("o_custkey") % 10 == 0, "CHANGED").otherwise(F.col("o_orderpriority"))
    batch = orders.withColumn("o_orderpriority", changed)
    return scd2_merge(opened(orders, "2024-01-01"), batch, columns[:1], columns[1:], "2024-02-01")


# What each of these reads, for its rows per second.
INPUT_ROWS = {
    "history_from_event_log": "events",
    "history_from_order_log": "orders",
    "scd2_merge_orders": "orders",
    "as_of_join_shipments": "lineitem",
}


def timed(spark, fn) -> float:
    start = time.perf_counter()
    fn(spark, DATA).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: QUERIES[name] for name in HEADLINE}
    runs["scd2_merge_orders"] = merge_orders
    seconds = {}
    for name, fn in runs.items():
        timed(spark, fn)
        seconds[name] = round(min(timed(spark, fn) for _ in range(2)), 3)
    rate = {
        name: round(table(spark, DATA, source).count() / seconds[name])
        for name, source in INPUT_ROWS.items()
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rate,
                "sf": os.path.basename(DATA.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
