"""What a review found: rows at the border of a rule, and plans that grow with more than their input."""

from __future__ import annotations

import os
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import TABLES, compare, connect
from palimpsest.operators import slices
from palimpsest.operators.history import as_of_join
from palimpsest.plans.refresh import enrich_uplinks
from palimpsest.plans.usage import refresh_usage
from palimpsest.resources import UPLINK, UPLINK_USAGE
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.suite import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables here")


def test_refresh_twice_balance_of_zero(spark, tmp_path):
    for name in TABLES:
        if name not in ("customer", "supplier"):
            os.symlink(f"{DATA}/{name}.parquet", tmp_path / f"{name}.parquet")
    for name, key, balance in (("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal")):
        rows = pq.read_table(f"{DATA}/{name}.parquet")
        some = pc.equal(pc.bit_wise_and(rows[key], 3), 0)
        zero = pc.if_else(some, pa.scalar(0.0), rows[balance])
        pq.write_table(rows.set_column(rows.schema.get_field_index(balance), balance, zero), tmp_path / f"{name}.parquet")
    data = str(tmp_path)
    problem, rows = compare(spark, connect(data), data, QUERIES["refresh_twice"], ORACLE["refresh_twice"])
    assert problem is None and rows == 11, problem


def test_refresh_usage_scans_readings_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    # Before the lookback, in the window, at its end, without an organization or a time.
    times = [datetime(1998, 3, 1), datetime(1998, 5, 2), datetime(1998, 5, 3), datetime(1998, 5, 4), None]
    rows = [(o, "N1", "S1", "wan1", t, 1, 2) for o in ("R1", None) for t in times]
    kinds = "org_id string, network_id string, serial string, interface string, ts timestamp, sent bigint, received bigint"
    events = spark.createDataFrame(rows, kinds)
    events = events.mapInArrow(counted, events.schema)
    networks = spark.createDataFrame([("N1", "R1")], "id string, organization_id string")
    store = KeyedStore.of(spark, str(tmp_path), UPLINK_USAGE)
    assert refresh_usage(store, events, networks, "1998-05-04") == {"upserted": 1}
    assert [(r.month, r.sent, r.received) for r in store.rows().collect()] == [(5, 2, 4)]
    assert seen.value == len(rows)


def _counted(df, seen):
    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("local", [1, 10_000])
def test_as_of_join_hot_keys_reads_its_input_a_few_times(spark, monkeypatch, local):
    monkeypatch.setattr(slices, "LOCAL", local)
    day = [datetime(2024, 1, 1 + d) for d in range(30)]
    facts = spark.createDataFrame([(k, d, k * 100 + i) for k in range(4) for i, d in enumerate(day)], "k int, at timestamp, f int")
    versions = [(k, a, b, f"{k}-{a.day}") for k in range(4) for a, b in zip(day[k::3], [*day[k + 3 :: 3], None])]
    history = spark.createDataFrame(versions, "k int, active_from timestamp, active_to timestamp, v string")
    read = [spark.sparkContext.accumulator(0) for _ in range(2)]
    joined = as_of_join(_counted(facts, read[0]), _counted(history, read[1]), ["k"], "at", ["v"], "left", rows_per_slice=5)
    got = {(r.k, r.at): r.v for r in joined.collect()}
    assert got == {(k, d): next((v for j, a, b, v in versions if j == k and a <= d and (b is None or d < b)), None) for k in range(4) for d in day}
    # To find the hot keys, for their rows, and for the others; facts once more for those without key or time.
    assert read[0].value <= 4 * 120 and read[1].value <= 3 * len(versions), [r.value for r in read]


def test_rows_of_a_commit_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """One bucket of narrow rows is small as bytes: several tasks write it all the same."""
    monkeypatch.setattr("palimpsest.sources.store.ROWS_PER_TASK", 100, raising=False)
    schema = T.StructType.fromDDL("k bigint, v string, active_from timestamp_ntz, active_to timestamp_ntz, last_seen timestamp_ntz")
    store = HistoryStore(spark, str(tmp_path / "t"), ["k"], schema)
    assert store.merge(spark.range(1000).selectExpr("id as k", "'a' as v"), "2024-01-01")["inserted"] == 1000
    counts = store.merge(spark.range(1000).selectExpr("id as k", "if(id < 300, 'b', 'a') as v"), "2024-01-02")
    assert counts == {"inserted": 0, "updated": 700, "expired+inserted": 300}
    files = [r["n"] for r in store.open_rows().groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()]
    assert len(files) > 5 and max(files) < 400
    assert store.history().count() == 1300 and store.open_rows().where("v = 'b'").count() == 300


def test_a_log_batch_is_not_turned_into_text(spark, tmp_path, monkeypatch):
    """Only a snapshot needs its size as text, for its broadcast; a log batch never does."""

    def refused(*_):
        raise AssertionError("a log batch as text")

    schema = T.StructType.fromDDL("k bigint, v string, active_from timestamp_ntz, active_to timestamp_ntz, last_seen timestamp_ntz")
    store = HistoryStore(spark, str(tmp_path / "t"), ["k"], schema)
    monkeypatch.setattr(F, "to_json", refused)
    store.merge_log(spark.range(9).selectExpr("id % 3 as k", "string(id) as v", "timestamp_ntz'2024-01-01' + make_dt_interval(id) as t"), "t")
    assert store.history().count() == 9
    with pytest.raises(AssertionError, match="as text"):
        store.merge(spark.range(3).selectExpr("id as k", "'a' as v"), "2024-02-01")


def test_known_uplinks_are_not_broadcast(spark, tmp_path):
    """Repetitive rows take few bytes in files and many times that in a broadcast, which passes through the driver."""
    declared = T.StructType(UPLINK.schema.fields[:-3])

    def uplinks(rows):
        kinds = "serial string, interface string, public_ip string, provider string"
        given = spark.createDataFrame(rows, kinds)
        return given.select(*[F.col(f.name) if f.name in given.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in declared])

    store = HistoryStore.of(spark, str(tmp_path), UPLINK)
    known = [("S1", "wan1", "10.0.0.1", "A"), ("S1", "wan2", None, "B"), ("S2", "wan1", "10.0.0.2", "C"), ("S4", "wan1", "10.0.0.4", None)]
    store.merge(uplinks(known), "2024-01-01")
    fresh = [(s, i, p, None) for s, i, p, _ in known] + [("S3", "wan1", "10.0.0.3", None), (None, "wan1", "10.0.0.1", None)]
    fresh[2] = ("S2", "wan1", "10.0.0.9", None)
    served = enrich_uplinks(uplinks(fresh), store.open_rows())
    got = sorted(((r.serial, r.interface, r.public_ip, r.provider) for r in served.collect()), key=str)
    assert got == sorted([*known[:2], *fresh[2:]], key=str)
    assert "Broadcast" not in served._jdf.queryExecution().executedPlan().toString()
