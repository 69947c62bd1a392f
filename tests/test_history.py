"""Histories against a fold that merges one observation after the other."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from palimpsest.operators.history import (
    as_of,
    as_of_join,
    at_time,
    current,
    history_from_log,
    open_row_violations,
    stale,
)
from palimpsest.operators.merge import CLOSED, OPEN, merge_log
from palimpsest.operators import slices
from palimpsest.operators.slices import HOT, SLICE, hot_keys, sliced

START = datetime(2024, 1, 1)
LOG = "k int, v string, w int, t timestamp_ntz, n int"


def random_log(seed, size=400, keys=4, span=150, hot=0.6):
    rng = random.Random(seed)
    out = []
    for n in range(size):
        key = 0 if rng.random() < hot else rng.randrange(1, keys)
        value = rng.choice(["a", "b", None])
        out.append((key, value, rng.randrange(2), START + timedelta(minutes=rng.randrange(span)), n))
    return out


def fold(log):
    """Versions by merging the last row of every (key, time) in order."""
    last = {}
    for row in sorted(log, key=lambda r: (r[3], r[4])):
        last[(row[0], row[3])] = row
    open_, done = {}, []
    for key, v, w, t, _ in sorted(last.values(), key=lambda r: r[3]):
        have = open_.get(key)
        if have is None:
            open_[key] = [key, v, w, t, None, t]
        elif (have[1], have[2]) == (v, w):
            have[5] = t
        else:
            done.append((*have[:4], t, have[5]))
            open_[key] = [key, v, w, t, None, t]
    return sorted(map(str, [*done, *[tuple(r) for r in open_.values()]]))


def as_text(history):
    return sorted(str(tuple(r)) for r in history.collect())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("per_slice", [None, 4_000_000, 40, 3])
def test_history_equals_fold(spark, seed, per_slice):
    log = random_log(seed)
    df = spark.createDataFrame(log, LOG)
    got = history_from_log(df, ["k"], ["v", "w"], "t", ["n"], rows_per_slice=per_slice)
    assert as_text(got) == fold(log)


def test_history_invariants(spark):
    log = random_log(7)
    history = history_from_log(spark.createDataFrame(log, LOG), ["k"], ["v", "w"], "t", ["n"]).cache()
    assert open_row_violations(history, ["k"]).count() == 0
    by_key = {}
    for r in rows(history, "k", "active_from"):
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        for a, b in zip(versions, versions[1:]):
            assert a["active_to"] == b["active_from"]
            assert a["active_from"] <= a["last_seen"] < a["active_to"]
    for minute in (0, 33, 149):
        found = as_of(history, START + timedelta(minutes=minute))
        assert found.groupBy("k").count().where("count > 1").count() == 0


def test_bounds_are_half_open(spark):
    log = [(1, "a", 0, START, 0), (1, "b", 0, START + timedelta(hours=1), 1)]
    history = history_from_log(spark.createDataFrame(log, LOG), ["k"], ["v"], "t", ["n"])
    value = lambda ts: [r.v for r in as_of(history, ts).collect()]
    assert value("2023-12-31 23:59:59") == []
    assert value(START) == ["a"]
    assert value("2024-01-01 00:59:59") == ["a"]
    assert value("2024-01-01 01:00:00") == ["b"]
    assert [r.v for r in at_time(history).collect()] == ["b"]
    assert at_time(history, "all").count() == 2
    assert current(history).count() == 1


def test_json_columns_in_a_log(spark):
    log = [(1, '{"a":1,"b":2}', START, 0), (1, '{"b":2, "a":1}', START + timedelta(1), 1), (1, "[]", START + timedelta(2), 2), (1, None, START + timedelta(3), 3)]
    df = spark.createDataFrame(log, "k int, j string, t timestamp, n int")
    history = history_from_log(df, ["k"], ["j"], "t", ["n"], json_cols=["j"])
    assert history.count() == 2


def test_stale(spark):
    log = [(1, "a", 0, START, 0), (2, "a", 0, START + timedelta(days=9), 1)]
    history = history_from_log(spark.createDataFrame(log, LOG), ["k"], ["v"], "t", ["n"])
    assert [r.k for r in stale(history, START + timedelta(days=10), "5 days").collect()] == [1]


@pytest.mark.parametrize("per_slice", [None, 20])
def test_log_in_batches_equals_one_pass(spark, per_slice):
    log = sorted(random_log(11), key=lambda r: r[3])
    cuts = [0, 1, 57, 300, len(log)]
    schema = "k int, v string, w int, active_from timestamp_ntz, active_to timestamp_ntz, last_seen timestamp_ntz"
    open_rows, closed = spark.createDataFrame([], schema), []
    for a, b in zip(cuts, cuts[1:]):
        batch = spark.createDataFrame(log[a:b], LOG)
        merged = merge_log(open_rows, batch, ["k"], ["v", "w"], "t", ["n"], rows_per_slice=per_slice)
        out = merged.collect()
        columns = schema.replace(",", "").split()[::2]
        pick = lambda part: [tuple(r[c] for c in columns) for r in out if r["_part"] == part]
        closed += pick(CLOSED)
        open_rows = spark.createDataFrame(pick(OPEN), schema)
    got = sorted(str(r) for r in [*closed, *[tuple(r) for r in open_rows.collect()]])
    assert got == fold(log)


def brute_join(facts, versions):
    out = []
    for key, t, n in facts:
        hit = [v for v in versions if v[0] == key and t is not None and v[3] <= t and (v[4] is None or v[4] > t)]
        assert len(hit) <= 1
        out.append((key, t, n, *((hit[0][1], hit[0][3]) if hit else (None, None))))
    return out


@pytest.mark.parametrize("per_slice", [None, 4_000_000, 15])
def test_as_of_join(spark, per_slice):
    log = random_log(5)
    history = history_from_log(spark.createDataFrame(log, LOG), ["k"], ["v", "w"], "t", ["n"])
    versions = [tuple(r) for r in history.collect()]
    # One key's last version is closed: the facts after it have no version.
    versions = [v[:4] + (v[5] + timedelta(minutes=1),) + v[5:] if v[0] == 1 and v[4] is None else v for v in versions]
    stored = spark.createDataFrame(versions, history.schema)
    rng = random.Random(1)
    facts = [(rng.choice([0, 0, 0, 1, 2, 9]), START + timedelta(minutes=rng.randrange(-10, 170)), n) for n in range(300)]
    facts += [(None, START, 300), (0, None, 301)]
    df = spark.createDataFrame(facts, "k int, t timestamp_ntz, n int")
    joined = as_of_join(df, stored, ["k"], "t", ["v"], how="left", rows_per_slice=per_slice)
    got = {r.n: (r.k, r.t, r.n, r.v, r.active_from) for r in joined.collect()}
    assert got == {r[2]: r for r in brute_join(facts, versions)}
    inner = as_of_join(df, stored, ["k"], "t", ["v"], rows_per_slice=per_slice)
    assert inner.count() == sum(r[4] is not None for r in brute_join(facts, versions))
    with pytest.raises(ValueError):
        as_of_join(df, stored, ["k"], "t", ["v"], how="full")


@pytest.mark.parametrize("per_slice", [None, 50])
def test_one_key_at_one_time(spark, per_slice):
    """Most rows share their key and their time: history keeps the last, the join keeps all."""
    log = random_log(13, size=100) + [(0, "z", 1, START + timedelta(minutes=70), n) for n in range(1000, 1600)]
    df = spark.createDataFrame(log, LOG)
    history = history_from_log(df, ["k"], ["v", "w"], "t", ["n"], rows_per_slice=per_slice)
    assert as_text(history) == fold(log)
    facts = df.select("k", F.col("t").alias("at"), "n")
    joined = as_of_join(facts, history, ["k"], "at", ["v"], rows_per_slice=per_slice)
    got = joined.where("k = 0 and minute(at) = 10 and hour(at) = 1").groupBy("v").count().collect()
    assert joined.count() == len(log) and max(r["count"] for r in got if r.v == "z") >= 600


@pytest.mark.parametrize("kind", ["bigint", "string", "date"])
def test_slices_follow_the_order(spark, kind):
    place = {"bigint": F.col("id"), "string": F.lpad("id", 5, "0"), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))}
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), place[kind].alias("x"), "id")
    cut, any_hot = sliced(df.where("k = 0 or id < 10"), ["k"], "x", rows_per_slice=100)
    assert any_hot
    found = cut.groupBy("k", SLICE, HOT).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n"))
    hot = rows(found.where(HOT), SLICE)
    assert {r["k"] for r in hot} == {0} and all(r["n"] <= 200 for r in hot) and len(hot) >= 5
    ordered = sorted(hot, key=lambda r: r[SLICE])
    assert all(a["hi"] < b["lo"] for a, b in zip(ordered, ordered[1:]))
    assert found.where(~F.col(HOT)).count() == 1
    assert hot_keys(df, ["k"], 10).count() == 2
    assert not sliced(df, ["k"], "x", rows_per_slice=900)[1]


def test_bursts_of_one_key_are_cut(spark):
    """Nine tenths of a key's rows lie in a thousandth of its time."""
    burst = F.when(F.col("id") % 10 == 0, F.col("id") * 1_000_000).otherwise(5_000_000_000 + F.col("id"))
    df = spark.range(20_000).select(F.lit(1).alias("k"), burst.alias("x"))
    cut, _ = sliced(df, ["k"], "x", rows_per_slice=1000)
    sizes = [r["count"] for r in cut.groupBy(SLICE).count().collect()]
    assert max(sizes) <= 2000 and sum(sizes) == 20_000


def test_many_hot_keys_stay_a_query(spark, monkeypatch):
    monkeypatch.setattr(slices, "LOCAL", 1)
    df = spark.range(600).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    cut, any_hot = sliced(df, ["k"], "x", rows_per_slice=50)
    assert any_hot and cut.where(HOT).count() == 600 and cut.groupBy("k", SLICE).count().count() >= 12


def test_a_log_row_without_time_fails(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 5)], "k int, v string, t long")
    with pytest.raises(Exception, match="NULL in a log"):
        history_from_log(df, ["k"], ["v"], "t").collect()


def test_as_of_join_of_dates_on_times(spark):
    versions = [(1, "old", datetime(2020, 1, 1), datetime(2020, 1, 5, 12)), (1, "new", datetime(2020, 1, 5, 12), None)]
    stored = spark.createDataFrame(versions, "k int, v string, active_from timestamp_ntz, active_to timestamp_ntz")
    facts = spark.sql("select 1 as k, explode(array(date'2020-01-05', date'2020-01-06')) as d")
    for per_slice in (None, 1):
        got = {str(r.d): r.v for r in as_of_join(facts, stored, ["k"], "d", ["v"], rows_per_slice=per_slice).collect()}
        assert got == {"2020-01-05": "old", "2020-01-06": "new"}
