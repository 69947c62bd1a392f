"""Usage readings into monthly counters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from palimpsest.functions.times import Moment, moment
from palimpsest.operators.convert import explode_children, rename_raw
from palimpsest.operators.counters import (
    LOOKBACK,
    accumulate,
    in_windows,
    monthly_delta,
    plan_windows,
    read_month,
)
from palimpsest.operators.merge import UPSERTED
from palimpsest.resources import UPLINK_USAGE
from palimpsest.session import step_path, written
from palimpsest.sources.store import KeyedStore, Source

KEYS = ["network_id", "serial", "interface"]
MEASURES = ["sent", "received"]


def usage_events(raw: DataFrame) -> DataFrame:
    """Landed usage readings as one row per uplink, with organization and time."""
    flat = explode_children(raw, UPLINK_USAGE.children, ["orgId", "networkId", "ts"])
    named = rename_raw(flat, UPLINK_USAGE.overrides)
    return named.select(
        "org_id",
        "network_id",
        "serial",
        "interface",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("sent").cast("bigint").alias("sent"),
        F.col("received").cast("bigint").alias("received"),
    )


def usage_of_month(
    events: DataFrame, now: Moment, month: int | None = None, year: int | None = None
) -> DataFrame:
    """Usage of a month straight from the readings, without stored counters."""
    return read_month(events, KEYS, MEASURES, "ts", now, month, year)


# Where the counters' commits note up to when an organization's readings are counted.
READ_UNTIL = "read_until"


def refresh_usage(
    store: KeyedStore,
    events: DataFrame,
    networks: DataFrame,
    now: datetime | str,
    source: Source | None = None,
) -> dict[str, int]:
    """Adds the readings of every organization's next window to the counters.

    Each commit notes the end of the window of every organization that had readings in it, so a network that is no longer
    there takes nothing from what is known to be read. Counters stored without such notes count from their latest reading.
    There is a window for each organization; they are read before the plan is built. The readings are scanned once: what any
    window can hold goes to the shared folder, and the organizations are noted on the way.
    """
    by = ["org_id"]
    spark = events.sparkSession
    noted = store.notes().get(READ_UNTIL, {})
    owner = networks.select(F.col("id").alias("network_id"), F.col("organization_id").alias("org_id"))
    state = store.rows().join(owner, "network_id").select("org_id", "last_seen")
    if noted:
        known = spark.createDataFrame([(o, t) for o, t in noted.items()], "org_id string, read long")
        read = known.select("org_id", F.timestamp_micros("read").alias("last_seen"))
        state = state.join(known.select("org_id"), "org_id", "left_anti").union(read)
    at, t = F.col("ts"), moment(now, events.schema["ts"].dataType)
    found_orgs, path = Observation(), step_path(spark)
    noting = events.observe(found_orgs, F.collect_set("org_id").alias("orgs"))
    recent = written(noting.where((at >= t - F.expr(f"interval {LOOKBACK}")) & (at < t)), path)
    groups = spark.createDataFrame([(o,) for o in found_orgs.get["orgs"] or []], "org_id string")
    planned = plan_windows(groups, state, by, now)
    found = planned.select("org_id", F.unix_micros("t0").alias("t0"), F.unix_micros("t1").alias("t1")).collect()
    if not found:
        store.commits.delete(path)
        return {UPSERTED: 0}
    local = spark.createDataFrame([tuple(r) for r in found], "org_id string, t0 long, t1 long")
    windows = local.select("org_id", F.timestamp_micros("t0").alias("t0"), F.timestamp_micros("t1").alias("t1"))
    inside = in_windows(recent, windows, by, "ts")
    had = {r["org_id"] for r in inside.select("org_id").distinct().collect()}
    outcomes = store.change(
        monthly_delta(inside, KEYS, MEASURES, "ts"),
        now,
        lambda held, new: accumulate(held, new, UPLINK_USAGE.keys, MEASURES),
        source,
        notes={READ_UNTIL: noted | {r["org_id"]: r["t1"] for r in found if r["org_id"] in had}},
    )
    store.commits.delete(path)
    return outcomes
