"""Counters: windows per group, accumulation, months, late events."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from palimpsest.operators.counters import (
    accumulate,
    for_month,
    in_windows,
    monthly_delta,
    plan_windows,
    split_late,
)
from palimpsest.plans.report import usage_report

NOW = datetime(2026, 3, 20, 12)
KEYS = ["network_id", "serial", "interface", "month", "year"]
STATE = "network_id string, serial string, interface string, month int, year int, sent bigint, received bigint, last_seen timestamp"


def windows(spark, *seen):
    groups = spark.createDataFrame([(o,) for o, _ in seen], "org string")
    state = spark.createDataFrame([(o, t) for o, t in seen if t], "org string, last_seen timestamp")
    return {r["org"]: r for r in rows(plan_windows(groups, state, ["org"], NOW))}


def test_windows(spark):
    got = windows(
        spark, ("new", None), ("recent", NOW - timedelta(days=2)), ("behind", NOW - timedelta(days=20)), ("lost", NOW - timedelta(days=40))
    )
    first = datetime(2026, 3, 1)
    assert (got["new"]["t0"], got["new"]["t1"]) == (first, first + timedelta(days=14))
    assert (got["recent"]["t0"], got["recent"]["t1"]) == (NOW - timedelta(days=2), NOW)
    assert got["behind"]["t1"] == NOW - timedelta(days=6)
    assert got["behind"]["lost_from"] is None
    limit = NOW - timedelta(days=30)
    assert (got["lost"]["t0"], got["lost"]["lost_from"], got["lost"]["lost_to"]) == (limit, NOW - timedelta(days=40), limit)


def test_first_day_of_month_is_within_the_limit(spark):
    groups = spark.createDataFrame([("o",)], "org string")
    state = spark.createDataFrame([], "org string, last_seen timestamp")
    (got,) = rows(plan_windows(groups, state, ["org"], datetime(2026, 1, 31, 23)))
    assert got["t0"] == datetime(2026, 1, 1, 23)


def state(spark, *items):
    return spark.createDataFrame(list(items), STATE)


def test_accumulate(spark):
    t1 = NOW
    have = state(
        spark,
        ("n", "s1", "wan1", 3, 2026, 37, 41, NOW - timedelta(days=1)),
        ("n", "s2", "wan1", 3, 2026, None, 5, NOW - timedelta(days=1)),
        ("n", "s3", "wan1", 3, 2026, None, 7, NOW - timedelta(days=1)),
    )
    delta = state(
        spark,
        ("n", "s1", "wan1", 3, 2026, 5, 9, t1),
        ("n", "s2", "wan1", 3, 2026, 10, None, t1),
        ("n", "new", "wan1", 3, 2026, 13, 17, t1),
    )
    got = {r["serial"]: (r["sent"], r["received"], r["last_seen"]) for r in rows(accumulate(have, delta, KEYS, ["sent", "received"]))}
    assert got == {
        "s1": (42, 50, t1),
        "s2": (10, 5, t1),
        "s3": (None, 7, NOW - timedelta(days=1)),
        "new": (13, 17, t1),
    }


def test_delta_by_event_month_and_window(spark):
    bounds = spark.createDataFrame(
        [("a", datetime(2026, 2, 27), datetime(2026, 3, 2)), ("b", datetime(2026, 3, 1), datetime(2026, 3, 2))],
        "org string, t0 timestamp, t1 timestamp",
    )
    events = spark.createDataFrame(
        [
            ("a", "k", datetime(2026, 2, 26, 23), 1),
            ("a", "k", datetime(2026, 2, 27), 2),
            ("a", "k", datetime(2026, 2, 28), 4),
            ("a", "k", datetime(2026, 3, 1), None),
            ("a", "k", datetime(2026, 3, 2), 8),
            ("b", "k2", datetime(2026, 3, 1), 16),
            ("b", "k2", datetime(2026, 2, 28), 32),
        ],
        "org string, key string, ts timestamp, sent bigint",
    )
    delta = monthly_delta(in_windows(events, bounds, ["org"], "ts"), ["key"], ["sent"], "ts")
    got = {(r["key"], r["year"], r["month"]): (r["sent"], r["last_seen"]) for r in rows(delta)}
    end = datetime(2026, 3, 2)
    assert got == {("k", 2026, 2): (6, end), ("k", 2026, 3): (0, end), ("k2", 2026, 3): (16, end)}


def test_months_are_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        events = spark.sql("select 'k' as k, timestamp '2026-03-01T02:00:00Z' as ts, 1L as n, timestamp '2026-03-02T00:00:00Z' as last_seen")
        delta = monthly_delta(events, ["k"], ["n"], "ts")
        assert [(r.year, r.month) for r in delta.collect()] == [(2026, 3)]
        groups = spark.sql("select 'o' as org")
        seen = spark.sql("select 'o' as org, cast(null as timestamp) as last_seen")
        plan = plan_windows(groups, seen, ["org"], "2026-03-05").select(F.unix_seconds("t0").alias("t0"))
        assert plan.first().t0 == 1772323200
        have = delta.withColumn("last_seen", F.col("last_seen"))
        assert for_month(have, "2026-03-01 01:00:00").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_for_month(spark):
    have = state(spark, *[("n", "s", "w", m, y, 1, 1, NOW) for m, y in ((3, 2026), (2, 2026), (3, 2025))])
    assert for_month(have, NOW).count() == 1
    assert for_month(have, NOW, month=2).count() == 1
    assert for_month(have, NOW, year=2025).count() == 1


def test_split_late(spark):
    events = spark.createDataFrame([(NOW - timedelta(days=d),) for d in (1, 30, 31)], "ts timestamp")
    assert [r.late for r in split_late(events, "ts", NOW).orderBy(F.desc("ts")).collect()] == [False, False, True]


def test_usage_report(spark):
    gb = 1073741824
    usage = state(
        spark,
        ("n1", "s", "wan1", 2, 2026, gb, 2 * gb, NOW),
        ("n1", "s", "wan1", 3, 2026, gb, None, NOW),
        ("n2", "s", "wan1", 3, 2026, gb, gb, NOW),
        ("gone", "s", "wan1", 3, 2026, gb, gb, NOW),
    )
    networks = spark.createDataFrame(
        [("n1", "Old", NOW), ("n1", "Main", None), ("n2", None, None), ("gone", "Gone", NOW)],
        "id string, name string, active_to timestamp",
    )
    got = [
        (r.network_name, r.month, float(r.sent_gb), r.total_gb if r.total_gb is None else float(r.total_gb))
        for r in usage_report(usage, networks).collect()
    ]
    assert got == [("Main", 3, 1.0, None), (None, 3, 1.0, 2.0), ("Main", 2, 1.0, 3.0)]
