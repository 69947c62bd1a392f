"""Records kept apart, events counted once, and SQL functions as of a time."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.rejects import accepted, checked, read_lenient, rejected
from palimpsest.plans.read import read, snapshot
from palimpsest.resources import DEVICE, NETWORK, SWITCHPORT, VLAN
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.sources.views import register_functions
from palimpsest.streaming.ingest import late_events, stream_counters
from test_tables import RECORDS, land


def test_records_without_faults_are_as_ever(spark, tmp_path):
    root = land(tmp_path)
    for spec in RECORDS:
        if not spec.versioned:
            continue
        rows = checked(read_lenient(spark, f"{root}/{spec.name}", spec), spec)
        want = snapshot(spark, spec, f"{root}/{spec.name}")
        assert rejected(rows).count() == 0, spec.name
        assert sorted(map(str, accepted(rows).collect())) == sorted(map(str, want.collect())), spec.name


def test_faults_and_their_reasons(spark, tmp_path):
    good = [{"networkId": "n1", "id": 1, "name": "a"}, {"networkId": "n1", "id": "2", "name": "b", "mask": None}]
    bad = [{"networkId": "n1", "id": "x", "name": "c", "mask": 1.5}, {"id": 3, "name": "d"}, {"networkId": "n2", "id": 4, "name": "e", "mask": "24b"}]
    lines = [*map(json.dumps, [*good, *bad]), '{"networkId": "n1", "id": ', "nonsense"]
    (tmp_path / "part.json").write_text("\n".join(lines))
    rows = checked(read_lenient(spark, str(tmp_path), VLAN), VLAN)
    assert rows.count() == 7
    assert sorted(r.vlan_id for r in accepted(rows).collect()) == [1, 2]
    faults = {(r.field, r.value, r.reason) for r in rejected(rows).collect()}
    assert faults == {
        ("vlan_id", "x", "does not fit int"), ("mask", "1.5", "does not fit int"), ("network_id", None, "missing"),
        ("mask", "24b", "does not fit int"), (None, None, "unreadable"),
    }
    assert {r.record for r in rejected(rows).where("reason = 'unreadable'").collect()} == set(lines[-2:])


def test_a_child_with_a_fault_leaves_its_siblings(spark, tmp_path):
    record = {"serial": "s1", "ports": [{"portId": "1", "enabled": True}, {"portId": "2", "enabled": "maybe"}, {"portId": None}]}
    (tmp_path / "part.json").write_text(json.dumps(record) + "\n{broken\n")
    rows = checked(read_lenient(spark, str(tmp_path), SWITCHPORT), SWITCHPORT)
    assert [(r.serial, r.port_id) for r in accepted(rows).collect()] == [("s1", "1")]
    assert {(r.field, r.reason) for r in rejected(rows).collect()} == {("enabled", "does not fit boolean"), ("port_id", "missing"), (None, "unreadable")}


def test_events_count_once_over_batches(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, year int, month int, n bigint, last_seen timestamp")
    store = KeyedStore(spark, f"{tmp_path}/counters", ["k", "year", "month"], schema, ["year", "month"])
    kind = "id int, k int, n bigint, ts timestamp"
    day = lambda d: datetime(2026, 1, d)
    batches = [
        [(1, 1, 10, day(10)), (1, 1, 10, day(10)), (2, 1, 5, day(11)), (3, 1, 7, None)],
        [(2, 1, 5, day(11)), (4, 2, 1, day(2)), (5, 1, 2, datetime(2025, 6, 1)), (9, 1, 1, day(30))],
        # The watermark has followed the thirtieth, but never passes `now`.
        [(1, 1, 10, day(10)), (4, 2, 1, day(2)), (6, 2, 3, day(1)), (None, 2, 1, day(5)), (None, 2, 1, day(5))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        stream = spark.readStream.schema(spark.createDataFrame([], kind).schema).parquet(f"{tmp_path}/landing")
        stream_counters(stream, store, ["n"], "ts", "2026-01-15", once_by=["id"]).awaitTermination()
    assert sorted((r.k, r.month, r.n) for r in store.rows().collect()) == [(1, 1, 16), (2, 1, 5)]
    aside = late_events(store, spark.createDataFrame([], kind))
    assert sorted((r.id, r.n) for r in aside.collect()) == [(3, 7), (5, 2)]


def test_sql_functions_are_reads(spark, tmp_path):
    store = HistoryStore.of(spark, str(tmp_path), DEVICE, buckets=2)
    types = ", ".join(f"{f.name} {f.dtype.simpleString()}" for f in DEVICE.fields)
    empty = {f.name: None for f in DEVICE.fields}
    for day, model in (("01", "a"), ("02", "b"), ("03", "c")):
        rows = [empty | {"serial": f"s{k}", "network_id": f"n{k % 2}", "model": model if k < 3 else "same"} for k in range(6)]
        store.merge(spark.createDataFrame([tuple(r[f.name] for f in DEVICE.fields) for r in rows], types), f"2026-01-{day}")
    names = register_functions(spark, str(tmp_path), "t_")
    assert "t_device_at" in names and not any("usage" in n for n in names)
    for ts in ("2025-12-31 00:00:00", "2026-01-01 12:00:00", "2026-01-02 00:00:00", "2026-03-01 00:00:00"):
        got = spark.sql(f"select * from t_device_at(timestamp '{ts}')")
        assert sorted(map(str, got.collect())) == sorted(map(str, read(DEVICE, store, ts).select(got.columns).collect()))
    assert spark.sql("select * from t_device_now() where model = 'c'").count() == 3
    assert spark.sql("select * from t_device_all()").count() == store.history().count()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = spark.sql("select serial from t_device_at(timestamp '2026-01-02') where model = 'b'")._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "EqualTo(model,b)" in plan and "LessThanOrEqual(active_from" in plan
