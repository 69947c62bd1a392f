"""Snapshot merges: outcomes, equality, checks, keyed tables, and equality with a fold."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from palimpsest.operators.history import history_from_log
from palimpsest.operators.merge import (
    closed_part,
    keyed_upsert,
    latest,
    open_part,
    outcome_counts,
    scd2_merge,
)

T0, T1 = datetime(2026, 1, 1), datetime(2026, 1, 2)
OPEN = "id string, label string, metadata string, active_from timestamp, active_to timestamp, last_seen timestamp"
BATCH = "id string, label string, metadata string"


def stored(spark, *items):
    return spark.createDataFrame([(i, l, m, T0, None, T0) for i, l, m in items], OPEN)


def merge(spark, have, batch, **options):
    return scd2_merge(
        have, spark.createDataFrame(batch, BATCH), ["id"], ["label", "metadata"], T1, json_cols=["metadata"], **options
    )


def counts(merged):
    return {r["outcome"]: r["rows"] for r in outcome_counts(merged).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_mixed_batch(spark, small):
    have = stored(spark, ("same", "hello", None), ("changed", "old", None), ("absent", "x", None))
    merged = merge(
        spark, have, [("same", "hello", None), ("changed", "updated", None), ("brand_new", "n", None)], small_batch=small
    )
    assert counts(merged) == {"inserted": 1, "updated": 1, "expired+inserted": 1}
    now_open = {r["id"]: r for r in rows(open_part(merged))}
    assert (now_open["same"]["active_from"], now_open["same"]["last_seen"]) == (T0, T1)
    assert (now_open["changed"]["active_from"], now_open["changed"]["label"]) == (T1, "updated")
    assert (now_open["absent"]["active_from"], now_open["absent"]["last_seen"]) == (T0, T0)
    assert now_open["brand_new"]["last_seen"] == T1
    (gone,) = rows(closed_part(merged))
    assert (gone["id"], gone["label"], gone["active_to"], gone["last_seen"]) == ("changed", "old", T1, T0)


def test_empty_batch_changes_nothing(spark):
    have = stored(spark, ("a", "x", None))
    merged = merge(spark, have, [])
    assert counts(merged) == {"inserted": 0, "updated": 0, "expired+inserted": 0}
    assert rows(open_part(merged)) == rows(have)


def test_large_first_batch(spark):
    batch = [(f"w{i}", "x", None) for i in range(500)]
    assert counts(merge(spark, stored(spark), batch)) == {"inserted": 500, "updated": 0, "expired+inserted": 0}


EQUALITY = [
    ("x", '{"k": "v"}', "x", '{"k":"v"}', True),
    ("x", '{"a":1,"b":2}', "x", '{"b":2,"a":1}', True),
    ("x", None, "x", "[]", True),
    ("x", "{}", "x", None, True),
    ("x", None, "x", '["x"]', False),
    ("443", None, "443", None, True),
    ("443", None, "443.0", None, False),
    (None, None, "x", None, False),
    (None, None, None, None, True),
]


@pytest.mark.parametrize("l1,m1,l2,m2,equal", EQUALITY)
def test_equality(spark, l1, m1, l2, m2, equal):
    found = counts(merge(spark, stored(spark, ("w", l1, m1)), [("w", l2, m2)]))
    assert found["updated" if equal else "expired+inserted"] == 1


def test_touch_keeps_stored_values(spark):
    merged = merge(spark, stored(spark, ("w", "x", '{"a":1}')), [("w", "x", '{ "a": 1 }')])
    assert rows(open_part(merged))[0]["metadata"] == '{"a":1}'


def test_extra_stored_column_is_ignored(spark):
    have = stored(spark, ("w", "x", None)).withColumn("legacy", F.lit("old"))
    assert counts(merge(spark, have, [("w", "x", None)]))["updated"] == 1


@pytest.mark.parametrize("small", [False, True])
def test_null_key_fails(spark, small):
    with pytest.raises(Exception, match="NULL in key column id"):
        merge(spark, stored(spark), [(None, "x", None)], small_batch=small).collect()


@pytest.mark.parametrize("small", [False, True])
def test_repeated_key_fails(spark, small):
    have = stored(spark, ("a", "x", None))
    with pytest.raises(Exception, match="more than once"):
        merge(spark, have, [("a", "x", None), ("a", "y", None)], small_batch=small).collect()


def test_repeated_key_last_wins(spark):
    batch = spark.createDataFrame([("a", "first", 1), ("a", "second", 2)], "id string, label string, n int")
    merged = scd2_merge(
        stored(spark).drop("metadata"), batch, ["id"], ["label"], T1, on_duplicate="last", order=["n"]
    )
    assert [r["label"] for r in rows(open_part(merged))] == ["second"]
    with pytest.raises(ValueError):
        merge(spark, stored(spark), [], on_duplicate="last")
    with pytest.raises(ValueError):
        merge(spark, stored(spark), [], on_duplicate="maybe")


def test_missing_columns_fail_at_once(spark):
    with pytest.raises(ValueError, match="metadata"):
        scd2_merge(stored(spark), stored(spark).drop("metadata"), ["id"], ["label", "metadata"], T1)


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y")], "k string, n int, v string")
    assert rows(latest(df, ["k"], ["n"])) == [{"k": "a", "n": 3, "v": None}, {"k": "b", "n": 2, "v": "y"}]


@pytest.mark.parametrize("seed", range(2))
def test_sequence_of_snapshots_equals_history_of_the_log(spark, seed):
    rng = random.Random(seed)
    have, closed, log = stored(spark), [], []
    for step in range(5):
        at = T0 + timedelta(days=step)
        keys = rng.sample(["a", "b", "c", "d", "e"], rng.randrange(1, 6))
        batch = [(k, rng.choice(["x", "y"]), rng.choice([None, '{"a":1}'])) for k in keys]
        log += [(*b, at) for b in batch]
        merged = scd2_merge(
            have,
            spark.createDataFrame(batch, BATCH),
            ["id"],
            ["label", "metadata"],
            at,
            ["metadata"],
            small_batch=bool(step % 2),
        ).collect()
        pick = lambda part: [tuple(r)[:6] for r in merged if r["_part"] == part]
        closed += pick("closed")
        have = spark.createDataFrame(pick("open"), OPEN)
    whole = history_from_log(
        spark.createDataFrame(log, BATCH + ", t timestamp"), ["id"], ["label", "metadata"], "t", json_cols=["metadata"]
    )
    assert sorted(map(str, [*closed, *[tuple(r) for r in have.collect()]])) == sorted(
        str(tuple(r)) for r in whole.collect()
    )


def test_keyed_upsert(spark):
    base = spark.createDataFrame([("a", 1, T0), ("b", 2, T0)], "id string, value int, last_seen timestamp")
    batch = spark.createDataFrame([("b", None, None), ("c", 3, T0)], "id string, value int, last_seen timestamp")
    got = rows(keyed_upsert(base, batch, ["id"], T1))
    assert got == [
        {"id": "a", "value": 1, "last_seen": T0},
        {"id": "b", "value": None, "last_seen": T1},
        {"id": "c", "value": 3, "last_seen": T0},
    ]
    without = batch.drop("last_seen")
    assert {r["last_seen"] for r in rows(keyed_upsert(base, without, ["id"], T1)) if r["id"] != "a"} == {T1}
