"""Enrichment, routing, differences, actions, schema evolution, payloads."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from palimpsest.operators.actions import action, chunk_actions, number_rows, update_actions
from palimpsest.operators.convert import normalize, rename_raw, to_payload, with_resource_path
from palimpsest.operators.diff import changed_fields, field_diff, version_churn
from palimpsest.operators.enrich import fill_by_range, ipv4_number, range_blocks, range_lookup, reuse
from palimpsest.operators.evolve import Add, Cast, Drop, Rename, downgrade, empty_table, upgrade
from palimpsest.operators.route import route, scope
from palimpsest.plans.refresh import enrich_uplinks
from palimpsest.resources import ALERT, RESOURCES, SSID, UPLINK, VLAN


def test_ipv4_number(spark):
    texts = ["0.0.0.0", "10.0.1.2", "255.255.255.255", "256.1.1.1", "1.2.3", "a.b.c.d", "::1", None, "1.2.3.4.5"]
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    got = [r[0] for r in df.select(ipv4_number(F.col("ip"))).collect()]
    assert got == [0, 167772418, 4294967295, None, None, None, None, None, None]


def test_blocks_make_up_the_range(spark):
    rng = random.Random(3)
    ranges = [(i, a, a + rng.randrange(0, 3000)) for i, a in enumerate(rng.randrange(-500, 4000) for _ in range(40))]
    ranges += [(100, 0, 65535), (101, 7, 7), (102, 0, 0), (103, 5, 4)]
    df = spark.createDataFrame(ranges, "i int, a bigint, b bigint")
    covered = {}
    for r in range_blocks(df, "a", "b", bits=12).collect():
        size = 16 ** r["_level"]
        numbers = set(range(r["_block"] * size, (r["_block"] + 1) * size))
        assert not numbers & covered.setdefault(r["i"], set())
        covered[r["i"]] |= numbers
    for i, a, b in ranges:
        assert covered.get(i, set()) == set(range(a, b + 1))


def test_ranges_far_beyond_the_bits_fail(spark):
    df = spark.createDataFrame([(0, 2**20)], "a bigint, b bigint")
    assert range_blocks(df, "a", "b", bits=12).count() > 0
    with pytest.raises(Exception, match="beyond 4 bits"):
        range_blocks(df, "a", "b", bits=4).collect()


def brute_lookup(points, ranges):
    out = {}
    for p in points:
        hits = [(rank, a - b, -a, v) for a, b, v, rank in ranges if p is not None and a <= p <= b]
        if hits:
            out[p] = max(hits)[3]
    return out


@pytest.mark.parametrize("bits", [4, 8, 16])
def test_range_lookup(spark, bits):
    rng = random.Random(bits)
    points = [rng.randrange(-100, 3000) for _ in range(300)] + [None]
    ranges = []
    for n in range(60):
        a = rng.randrange(-150, 3000)
        ranges.append((a, a + rng.randrange(0, 700), f"r{n}", rng.randrange(3)))
    got = range_lookup(
        spark.createDataFrame([(p,) for p in points], "p bigint"),
        spark.createDataFrame(ranges, "a bigint, b bigint, v string, rank int"),
        "p", "a", "b", "v", "rank", bits,
    )
    assert {r["p"]: r["v"] for r in got.collect()} == brute_lookup(points, ranges)


def test_range_lookup_without_ranges(spark):
    points = spark.createDataFrame([(1,)], "p bigint")
    ranges = spark.createDataFrame([], "a bigint, b bigint, v string, rank int")
    assert range_lookup(points, ranges, "p", "a", "b", "v", "rank").count() == 0


def test_fill_by_range(spark):
    df = spark.createDataFrame([("a", 5, "kept"), ("b", 5, None), ("c", 50, None), ("d", None, None)], "k string, p bigint, v string")
    ranges = spark.createDataFrame([(0, 9, "found", 1)], "a bigint, b bigint, v string, rank int")
    got = {r["k"]: r["v"] for r in fill_by_range(df, ranges, F.col("p"), "a", "b", "v", "rank").collect()}
    assert got == {"a": "kept", "b": "found", "c": None, "d": None}


def test_reuse(spark):
    fresh = spark.createDataFrame(
        [("same", "1"), ("moved", "2"), ("unknown", "1"), ("no_ip", None), ("no_provider", "1")], "k string, ip string"
    ).withColumn("provider", F.lit(None).cast("string"))
    known = spark.createDataFrame(
        [("same", "1", "P"), ("moved", "1", "P"), ("no_ip", None, "P"), ("no_provider", "1", None)], "k string, ip string, provider string"
    )
    got = {r["k"]: (r["provider"], r["reused"]) for r in rows(reuse(fresh, known, ["k"], "ip", "provider"))}
    assert got == {
        "same": ("P", True), "moved": (None, False), "unknown": (None, False), "no_ip": ("P", True), "no_provider": (None, False),
    }


def test_enrich_uplinks(spark):
    def uplinks(*items):
        return normalize(spark.createDataFrame(list(items), "serial string, interface string, public_ip string, provider string"), UPLINK)

    fresh = uplinks(("a", "wan1", "10.0.0.1", None), ("b", "wan1", "10.0.1.1", None), ("c", "wan1", None, None), ("d", "wan1", "9.9.9.9", None))
    known = uplinks(("a", "wan1", "10.0.0.1", "Known"), ("b", "wan1", "10.0.9.9", "Old"))
    registry = spark.createDataFrame(
        [(167772160, 167837695, 16, "Broad"), (167772416, 167772671, 24, "Narrow")], "start bigint, end bigint, prefix_len int, registrant string"
    )
    got = {r["serial"]: r["provider"] for r in enrich_uplinks(fresh, known, registry).collect()}
    assert got == {"a": "Known", "b": "Narrow", "c": None, "d": None}
    plain = enrich_uplinks(fresh, known)
    assert plain.columns == fresh.columns
    assert {r["serial"]: r["provider"] for r in plain.collect()} == {"a": "Known", "b": None, "c": None, "d": None}


def test_route_and_scope(spark):
    networks = spark.createDataFrame(
        [("n1", "o1", ["switch", "appliance", "wireless"]), ("n2", "o1", ["wireless"]), ("n3", "o2", None)],
        "id string, organization_id string, product_types array<string>",
    )
    feed = spark.createDataFrame([("n1", 1), ("n2", 2), ("n3", 3), ("n9", 4)], "network_id string, x int")
    kept = lambda df: sorted(r.x for r in df.collect())
    assert kept(route(feed, networks, "appliance")) == [1]
    assert kept(route(feed, networks, "wireless")) == [1, 2]
    assert kept(scope(feed, networks, "o2")) == [3]


def test_field_diff_and_changed_fields(spark):
    schema = "id string, name string, tags array<string>, meta string"
    left = spark.createDataFrame([("a", "x", ["t"], '{"k":1,"j":2}'), ("b", None, None, None), ("only", "x", None, None)], schema)
    right = spark.createDataFrame([("a", "y", ["t", "u"], '{"j":2,"k":1}'), ("b", None, [], "[]")], schema)
    args = (["id"], ["name", "tags", "meta"], ["meta"])
    got = rows(field_diff(left, right, *args), "id", "field")
    assert got == [
        {"id": "a", "field": "name", "left": "x", "right": "y"},
        {"id": "a", "field": "tags", "left": '["t"]', "right": '["t","u"]'},
    ]
    (changed,) = rows(changed_fields(left, right, *args))
    assert (changed["id"], changed["name"], changed["changed"]) == ("a", "x", ["name", "tags"])


def test_version_churn(spark):
    t = [datetime(2026, 1, d) for d in range(1, 5)]
    history = spark.createDataFrame(
        [("a", 1, "x", t[0], t[1]), ("a", 2, "x", t[1], t[2]), ("a", 3, "y", t[2], None), ("b", 1, "x", t[0], None)],
        "k string, n int, s string, active_from timestamp, active_to timestamp",
    )
    assert {r["field"]: r["changes"] for r in version_churn(history, ["k"], ["n", "s"]).collect()} == {"n": 2, "s": 1}


def actions_of(spark, n, group="org"):
    df = spark.range(n).select(F.lit(group).alias("org"), F.col("id").alias("n"))
    return df.withColumn("action", action(F.concat(F.lit("/x/"), F.col("n").cast("string")), F.lit("update"), F.lit('{"a":1}')))


@pytest.mark.parametrize("n,synchronous,sizes", [(101, False, [100, 1]), (43, True, [20, 20, 3]), (99, False, [99]), (20, True, [20]), (0, False, [])])
@pytest.mark.parametrize("per_slice", [None, 4_000_000, 7])
def test_chunks(spark, n, synchronous, sizes, per_slice):
    chunks = chunk_actions(actions_of(spark, n), ["org"], ["n"], synchronous, rows_per_slice=per_slice)
    got = chunks.orderBy("chunk").collect()
    assert [len(r.actions) for r in got] == sizes
    flat = [a.resource for r in got for a in r.actions]
    assert flat == [f"/x/{i}" for i in range(n)]


def test_number_rows(spark):
    df = spark.range(500).select((F.col("id") % 7 == 0).cast("int").alias("k"), (F.col("id") * 37 % 1000).alias("x"))
    got = number_rows(df, ["k"], ["x"], rows_per_slice=11)
    for key in (0, 1):
        part = sorted((r["x"], r["position"]) for r in got.where(F.col("k") == key).collect())
        assert [p for _, p in part] == list(range(len(part)))


@pytest.mark.parametrize(
    "resource,operation,body,message",
    [("", "update", "{}", "resource"), (None, "update", "{}", "resource"), ("/x", "", None, "operation"), ("/x", "update", "[1]", "body"), ("/x", "update", "text", "body")],
)
def test_bad_actions_fail(spark, resource, operation, body, message):
    df = spark.createDataFrame([(resource, operation, body)], "r string, o string, b string")
    with pytest.raises(Exception, match=message):
        df.select(action(F.col("r"), F.col("o"), F.col("b")).alias("a")).collect()


def test_action_without_body(spark):
    (row,) = spark.range(1).select(action(F.lit("/x"), F.lit("destroy")).alias("a")).collect()
    assert row.a.asDict() == {"resource": "/x", "operation": "destroy", "body": None}


def test_update_actions(spark):
    def ssids(*items):
        return normalize(spark.createDataFrame(list(items), "networkId string, number int, name string, enabled boolean, psk string, radiusServers string"), SSID)

    current = ssids(("n", 0, "Guest", True, "old", '[{"host":"h","port":1}]'), ("n", 1, "Same", True, "a", None))
    desired = ssids(("n", 0, None, True, "new", '[{"port":2,"host":"h"}]'), ("n", 1, "Same", True, "b", "[]"))
    (row,) = update_actions(desired, current, SSID).collect()
    assert row.action.resource == "/networks/n/wireless/ssids/0"
    assert json.loads(row.action.body) == {"name": None, "radiusServers": [{"host": "h", "port": 2}]}
    secret = update_actions(desired, current, SSID, sensitive=True)
    assert secret.count() == 2 and all("psk" in r.action.body for r in secret.collect())


def test_payload(spark):
    raw = spark.createDataFrame([("n", "10", "Data", None)], "networkId string, id string, name string, applianceIp string")
    (row,) = to_payload(normalize(raw, VLAN), VLAN, only=["vlan_id", "name", "appliance_ip"]).collect()
    assert json.loads(row.payload) == {"id": 10, "name": "Data", "applianceIp": None}
    (whole,) = to_payload(normalize(raw, VLAN), VLAN).collect()
    body = json.loads(whole.payload)
    assert set(body) == {f.raw_name for f in VLAN.fields} and "activeFrom" not in body


def test_resource_paths(spark):
    want = {
        "organization": "/organizations/k",
        "network": "/networks/k",
        "device": "/devices/k",
        "switchport": "/devices/k/switch/ports/k",
        "uplink": "/devices/k",
        "uplink_usage": "/networks/k/appliance/uplinks/usageHistory",
        "dhcp_server_policy": "/networks/k/switch/dhcpServerPolicy",
        "alert": "/organizations/k/assurance/alerts/k",
        "l3_firewall_rule": "/networks/k/appliance/firewall/l3FirewallRules",
        "vlan": "/networks/k/appliance/vlans/7",
        "ssid": "/networks/k/wireless/ssids/7",
        "appliance_malware": "/networks/k/appliance/security/malware",
    }
    for spec in RESOURCES.values():
        values = [F.lit(7 if f.kind in ("int", "bigint") else "k").alias(f.name) for f in spec.fields]
        (row,) = with_resource_path(spark.range(1).select(*values), spec).collect()
        assert row.resource_path == want[spec.name]


def test_rename_raw(spark):
    df = spark.createDataFrame([(1, 2)], "isActive int, type int")
    assert rename_raw(df, {"type": "widget_type"}).columns == ["is_active", "widget_type"]


def test_normalize_missing_and_bad_values(spark):
    with pytest.raises(ValueError, match="name"):
        normalize(spark.createDataFrame([("n", "1")], "networkId string, id string"), VLAN)
    bad = spark.createDataFrame([("n", "abc", "x")], "networkId string, id string, name string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalize(bad, VLAN).collect()
    assert normalize(bad, VLAN, strict=False).first().vlan_id is None


def test_alert_network_object(spark):
    schema = "id string, orgId string, networkId string, network struct<id:string,name:string>"
    df = spark.createDataFrame([("a", "o", None, ("n", "Net")), ("b", "o", "given", ("n", "Net")), ("c", "o", None, None)], schema)
    got = {r["id"]: (r["network_id"], r["network_name"]) for r in rows(normalize(df, ALERT))}
    assert got == {"a": ("n", "Net"), "b": ("given", "Net"), "c": (None, None)}
    odd = spark.createDataFrame([("a", "o", "text")], "id string, orgId string, network string")
    assert normalize(odd, ALERT).first().network_id is None


def test_evolution(spark):
    old = spark.createDataFrame([("s", "7", '["a","b"]', "x")], "device_serial string, id string, tags string, last_day string")
    steps = [Rename("device_serial", "serial"), Rename("id", "vlan_id"), Cast("vlan_id", "int"), Cast("tags", "array<string>"), Add("psk"), Drop("last_day"), Drop("absent")]
    new = upgrade(old, steps)
    assert new.first().asDict() == {"serial": "s", "vlan_id": 7, "tags": ["a", "b"], "psk": None}
    back = downgrade(new, steps).drop("absent")
    assert back.select(*old.columns).first().asDict() == {"device_serial": "s", "id": "7", "tags": '["a","b"]', "last_day": None}
    assert upgrade(new, [Rename("device_serial", "serial"), Add("psk")]).columns == new.columns
    with pytest.raises(ValueError):
        Rename("serial", "psk").apply(new)
    with pytest.raises(Exception):
        upgrade(spark.createDataFrame([("x",)], "id string"), [Cast("id", "int")]).collect()
    assert empty_table(spark, VLAN).schema == VLAN.schema
