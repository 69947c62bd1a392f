"""Stored tables: late rows, compaction, and columns that change without a rewrite."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.evolve import Add, Cast, Drop, Rename
from palimpsest.operators.history import as_of, history_from_log
from palimpsest.sources.store import HistoryStore, KeyedStore

TIMES = ("active_from", "active_to", "last_seen")
SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType()), *[T.StructField(c, T.TimestampType()) for c in TIMES]])
LOG = "k int, v string, t timestamp, n int"
START = datetime(2026, 1, 1)


def new_store(spark, path, **options):
    return HistoryStore(spark, str(path), ["k"], SCHEMA, **options)


def log_of(seed, n=300, keys=12):
    rng = random.Random(seed)
    times = sorted(rng.randrange(20_000) for _ in range(n))
    return [(rng.randrange(keys), rng.choice("abc"), START + timedelta(minutes=t), i) for i, t in enumerate(times)]


def by_key(df):
    return sorted(([str(x) for x in r] for r in df.select(*SCHEMA.names).collect()))


@pytest.mark.parametrize("buckets", [1, 4])
def test_late_rows_with_the_log(spark, tmp_path, buckets):
    rows = log_of(1)
    rng = random.Random(2)
    late = {i for i in range(200) if rows[i][0] in (0, 3, 11) and rng.random() < 0.4}
    frame = lambda which: spark.createDataFrame([rows[i] for i in which], LOG)
    log = frame([i for i in range(300) if i not in late])
    store = new_store(spark, tmp_path / "t", buckets=buckets, fanout=None)
    for low in range(0, 300, 60):
        store.merge_log(frame([i for i in range(low, low + 60) if i not in late]), "t", ["n"])
    before = {f for e in store.state()[1]["closed"] for f in store.commits.files(store._closed_dir(e))}
    outcomes = store.merge_late(frame(late), "t", ["n"], log, source=("late", 1))
    assert outcomes["rows"] == len(late) and outcomes["keys"] == 3
    full = history_from_log(frame(range(300)), ["k"], ["v"], "t", ["n"])
    assert by_key(store.history()) == by_key(full)
    for ts in ("2026-01-03", "2026-01-09"):
        assert by_key(store.at(ts)) == by_key(as_of(full, ts))
    # The same batch of the same source again changes nothing.
    assert store.merge_late(frame(late), "t", ["n"], log, source=("late", 1)) == outcomes
    assert all(os.path.exists(f.removeprefix("file:")) for f in before)
    # Later batches go on as ever.
    more = [(3, "z", datetime(2026, 2, 1), 1000), (50, "z", datetime(2026, 2, 1), 1001)]
    store.merge_log(spark.createDataFrame(more, LOG), "t", ["n"])
    full = history_from_log(frame(range(300)).union(spark.createDataFrame(more, LOG)), ["k"], ["v"], "t", ["n"])
    assert by_key(store.history()) == by_key(full)
    store.compact(2)
    assert by_key(store.history()) == by_key(full)


def test_only_files_with_touched_keys_are_replaced(spark, tmp_path):
    store = new_store(spark, tmp_path / "t", fanout=None)
    for day in range(1, 6):
        changed = [(k, f"v{day if k == day else 0}") for k in range(8)]
        store.merge(spark.createDataFrame(changed, "k int, v string"), f"2026-01-0{day}")
    files = [e["folder"] for e in store.state()[1]["closed"]]
    assert len(files) == 4
    # Key 2 was closed by the second and third snapshot only.
    late = spark.createDataFrame([(2, "late", datetime(2026, 1, 1, 12))], "k int, v string, t timestamp")
    assert store.merge_late(late, "t")["files"] == 2
    kept = [e["folder"] for e in store.state()[1]["closed"]]
    assert set(files) - set(kept) == set(files[:2])
    got = sorted((r.v, str(r.active_from)[:16]) for r in store.history().where("k = 2").collect())
    assert got == [("late", "2026-01-01 12:00"), ("v0", "2026-01-01 00:00"), ("v0", "2026-01-03 00:00"), ("v2", "2026-01-02 00:00")]
    assert store.history().where("k <> 2").count() == 2 + 3 + 3 + 2 + 3


def test_late_rows_without_a_log(spark, tmp_path):
    rows = log_of(3, 120, 5)
    frame = lambda some: spark.createDataFrame(some, LOG)
    store = new_store(spark, tmp_path / "t", buckets=3)
    store.merge_log(frame(rows), "t", ["n"])
    known = [(r.k, r.v, t, -1) for r in store.history().collect() for t in {r.active_from, r.last_seen}]
    late = [(k, "z", START + timedelta(minutes=m), 5) for k, m in ((0, 50), (1, 7000), (9, 3), (1, 7001), (4, 19_000))]
    late = [x for x in late if x[2] <= rows[-1][2]]
    store.merge_late(frame(late), "t", ["n"])
    assert by_key(store.history()) == by_key(history_from_log(frame(known + late), ["k"], ["v"], "t", ["n"]))


def test_what_is_not_late_is_refused(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    late = lambda *some: spark.createDataFrame(list(some), "k int, v string, t timestamp")
    with pytest.raises(ValueError, match="newer"):
        store.merge_late(late((1, "a", START)), "t")
    store.merge(spark.createDataFrame([(1, "a")], "k int, v string"), "2026-01-02")
    with pytest.raises(ValueError, match="newer"):
        store.merge_late(late((1, "a", datetime(2026, 1, 3))), "t")
    with pytest.raises(ValueError, match="no t"):
        store.merge_late(late((1, "a", None)), "t")
    with pytest.raises(Exception, match="NULL in key column k"):
        store.merge_late(late((None, "a", START)), "t")
    assert store.merge_late(late(), "t") == {"rows": 0, "keys": 0, "files": 0}
    # A key the table did not have.
    store.merge_late(late((7, "b", START)), "t")
    assert sorted((r.k, r.v) for r in store.open_rows().collect()) == [(1, "a"), (7, "b")]


def test_compaction_bounds_the_files_of_a_read(spark, tmp_path):
    store, plain = (new_store(spark, tmp_path / name, fanout=f) for name, f in (("t", 3), ("plain", None)))
    for day in range(14):
        batch = spark.createDataFrame([(k, f"{day * (k + 1) // 2}") for k in range(4)], "k int, v string").coalesce(1)
        for s in (store, plain):
            s.merge(batch, START + timedelta(days=day))
    entries = store.state()[1]["closed"]
    # Fewer than three folders in each of the tiers 0 to 2.
    assert len(entries) <= 6 < len(plain.state()[1]["closed"])
    assert by_key(store.history()) == by_key(plain.history())
    for day in (0, 7, 13):
        ts = START + timedelta(days=day, hours=3)
        assert by_key(store.at(ts)) == by_key(plain.at(ts))
        assert len(store.at(ts).inputFiles()) <= 5
    assert store.drop_old(keep=1) > 8
    assert by_key(store.history()) == by_key(plain.history())
    assert plain.compact(1000) == 0
    # In files of a few rows each, ranges that cannot hold a time are not read.
    assert plain.compact(2, rows_per_file=8) > 2
    ranges = plain.state()[1]["closed"]
    assert len(ranges) > 3 and len({e["folder"] for e in ranges}) == 1
    assert by_key(store.history()) == by_key(plain.history())
    assert len(plain.closed_rows("2026-01-13", "2026-01-13").inputFiles()) < len(ranges) / 2
    assert by_key(store.at("2026-01-13")) == by_key(plain.at("2026-01-13"))


def test_compaction_gives_way_to_another_writer(spark, tmp_path):
    store = new_store(spark, tmp_path / "t", fanout=None)
    for day in (1, 2, 3):
        store.merge(spark.createDataFrame([(1, f"{day}")], "k int, v string"), f"2026-01-0{day}")
    number, body = store.state()
    store.commits.write(number, body)  # another writer's marker
    real = store.state
    store.state = lambda: (number, body)
    with pytest.raises(Exception, match="exists"):
        store.compact(2)
    store.state = real
    assert store.history().count() == 3 and store.compact(2) == 2


@pytest.mark.parametrize("buckets", [1, 4])
def test_columns_change_without_a_rewrite(spark, tmp_path, buckets):
    schema = T.StructType.fromDDL("k int, v string, w string, active_from timestamp, active_to timestamp, last_seen timestamp")
    old = HistoryStore(spark, str(tmp_path / "t"), ["k"], schema, ["w"], buckets=buckets)
    one = "k int, v string, w string"
    old.merge(spark.createDataFrame([(1, "1", '["a"]'), (2, "2", None)], one), "2026-01-01")
    old.merge(spark.createDataFrame([(1, "11", '["a"]')], one), "2026-01-02")
    files = set(old.history().inputFiles())
    steps = [Rename("k", "id"), Cast("v", "int"), Rename("v", "count"), Cast("w", "array<string>"), Add("x", "double")]
    new = old.evolve(*steps)
    assert new.keys == ["id"] and new.json_cols == [] and new.schema.names[-1] == "x"
    assert set(new.history().inputFiles()) == files
    for use in (old.history, old.open_rows, lambda: old.merge(spark.createDataFrame([(1, "1", None)], one), "2026-01-05")):
        with pytest.raises(ValueError, match="other columns"):
            use()
    new.merge(spark.createDataFrame([(1, 11, ["a"], None), (2, 3, ["b"], 1.5)], "id int, count int, w array<string>, x double"), "2026-01-03")
    got = sorted((r.id, r["count"], r.w, r.x, r.active_to is None) for r in new.history().collect())
    assert got == [(1, 1, ["a"], None, False), (1, 11, ["a"], None, True), (2, 2, None, None, False), (2, 3, ["b"], 1.5, True)]
    assert sorted((r.id, r["count"]) for r in new.at("2026-01-01 12:00:00").collect()) == [(1, 1), (2, 2)]
    assert [r["count"] for r in new.open_rows(key=2).where("id = 2").collect()] == [3]
    third = new.evolve(Drop("x"), Rename("count", "n"))
    assert sorted((r.id, r.n) for r in third.history().collect()) == [(1, 1), (1, 11), (2, 2), (2, 3)]
    back = third.evolve(*[s.inverse() for s in reversed([*steps, Drop("x", "double"), Rename("count", "n")])])
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in schema}
    assert sorted((r.k, r.v, r.w) for r in back.history().collect()) == [(1, "1", '["a"]'), (1, "11", '["a"]'), (2, "2", None), (2, "3", '["b"]')]
    # Compaction and late rows write the newest columns.
    late = spark.createDataFrame([(2, "5", None, datetime(2026, 1, 2))], f"{one}, t timestamp")
    back = HistoryStore(spark, back.path, ["k"], schema, ["w"])
    back.merge_late(late, "t")
    back.compact(1)
    assert sorted((r.k, r.v) for r in back.history().collect()) == [(1, "1"), (1, "11"), (2, "2"), (2, "3"), (2, "5")]


def test_changes_that_are_refused(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    store.merge(spark.createDataFrame([(1, "x")], "k int, v string"), "2026-01-01")
    for step in (Drop("k"), Cast("k", "string"), Rename("active_to", "until"), Drop("last_seen")):
        with pytest.raises(ValueError, match="cannot be"):
            store.evolve(step)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store.evolve(Cast("v", "int"))
    assert store.history().count() == 1
    # Without a commit there is nothing to note.
    assert new_store(spark, tmp_path / "empty").evolve(Add("y")).history().columns[-1] == "y"


def test_a_keyed_table_evolves(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, month int, n bigint, last_seen timestamp")
    store = KeyedStore(spark, str(tmp_path / "t"), ["k", "month"], schema, ["month"])
    store.upsert(spark.createDataFrame([(1, 1, 10), (1, 2, 20)], "k int, month int, n bigint"), "2026-01-01")
    for step in (Rename("month", "m"), Drop("k"), Cast("month", "string")):
        with pytest.raises(ValueError):
            store.evolve(step)
    new = store.evolve(Rename("n", "total"), Add("note"))
    with pytest.raises(ValueError, match="other columns"):
        store.rows()
    new.upsert(spark.createDataFrame([(1, 2, 21, "x")], "k int, month int, total bigint, note string"), "2026-01-02")
    assert sorted((r.k, r.month, r.total, r.note) for r in new.rows().collect()) == [(1, 1, 10, None), (1, 2, 21, "x")]
    assert [r.total for r in new.rows(month=1).collect()] == [10]
