"""Landing, commits, reads with filters, streams and refreshes of the real resources."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from palimpsest.operators.convert import normalize
from palimpsest.operators.evolve import Add, Cast, Rename, upgrade
from palimpsest.operators.merge import scd2_merge
from palimpsest.plans.read import read, snapshot
from palimpsest.plans.refresh import refresh, refresh_levels
from palimpsest.plans.usage import usage_events, usage_of_month
from palimpsest.resources import (
    ALERT,
    APPLIANCE_MALWARE,
    DEVICE,
    DHCP_SERVER_POLICY,
    L3_FIREWALL_RULE,
    NETWORK,
    ORGANIZATION,
    RESOURCES,
    SSID,
    SWITCHPORT,
    UPLINK,
    UPLINK_USAGE,
    VLAN,
)
from palimpsest.session import session, shared_dir, shuffle_partitions
from palimpsest.sources.landing import read_landing, stream_landing
from palimpsest.sources.store import HistoryStore, KeyedStore
from palimpsest.sources.views import register_views
from palimpsest.streaming.ingest import late_events, stream_counters, stream_log, stream_snapshots

RECORDS = {
    ORGANIZATION: [{"id": "o1", "name": " Acme ", "url": "u", "api": {"enabled": True}, "licensing": {"model": "co-term"}, "extra": 1}],
    NETWORK: [
        {"id": "n1", "organizationId": "o1", "name": "b main", "productTypes": ["switch", "appliance", "wireless"], "timeZone": "UTC", "tags": ["hq"]},
        {"id": "n2", "organizationId": "o1", "name": "a Guest", "productTypes": ["wireless"]},
        {"id": "n3", "organizationId": "o2", "name": "c", "productTypes": ["switch"], "tags": []},
    ],
    DEVICE: [
        {"serial": "s1", "name": "Core", "networkId": "n1", "model": "MS120", "lat": 1, "tags": ["x"], "details": [{"name": "k", "value": "v"}], "beaconIdParams": {"uuid": "u", "major": 1, "minor": 2}},
        {"serial": "s2", "networkId": "n3", "model": "MX64", "lat": 1.5},
        {"serial": "s3", "networkId": "n1"},
    ],
    SWITCHPORT: [
        {"serial": "s1", "ports": [
            {"portId": "10", "enabled": False, "type": "trunk", "vlan": 0, "allowedVlans": "443"},
            {"portId": "2", "enabled": True, "type": "access", "vlan": 5, "stickyMacAllowList": ["m"]},
        ]},
        {"serial": "s2", "ports": []},
        {"serial": "s3"},
    ],
    UPLINK: [{"serial": "s1", "networkId": "n1", "uplinks": [{"interface": "wan1", "status": "active", "publicIp": "10.0.0.1", "ipAssignedBy": "dhcp", "signalStat": {"rsrp": "-1"}}, {"interface": "wan2", "status": "failed"}]}],
    UPLINK_USAGE: [
        {"orgId": "o1", "networkId": "n1", "ts": "2026-01-05T00:00:00Z", "byUplink": [{"serial": "s1", "interface": "wan1", "sent": 100, "received": 200}]},
        {"orgId": "o1", "networkId": "n1", "ts": "2026-01-12T00:00:00Z", "byUplink": [{"serial": "s1", "interface": "wan1", "sent": 10}, {"serial": "s1", "interface": "wan2", "sent": 1, "received": 1}]},
    ],
    DHCP_SERVER_POLICY: [
        {"networkId": "n1", "defaultPolicy": "block", "blockedServers": ["a"], "allowedServers": [], "arpInspection": {"enabled": True}},
        {"networkId": "n2", "defaultPolicy": "allow"},
    ],
    ALERT: [
        {"id": "a1", "orgId": "o1", "type": "down", "categoryType": "c", "severity": "critical", "network": {"id": "n1", "name": "Main"}, "scope": {"devices": [{"serial": "s1"}]}},
        {"id": "a2", "orgId": "o1", "type": "up", "severity": "warning", "resolvedAt": "2026-01-01T00:00:00Z"},
    ],
    L3_FIREWALL_RULE: [{"networkId": "n1", "rules": [{"comment": "c", "policy": "deny", "protocol": "tcp", "destPort": "443", "syslogEnabled": False}, {"policy": "allow", "protocol": "any", "destPort": "Any"}]}],
    VLAN: [
        {"networkId": "n1", "id": "10", "name": "Voice", "mask": 24, "fixedIpAssignments": {"m": {"ip": "i", "name": "n"}}, "ipv6": {"prefixAssignments": [], "enabled": False}},
        {"networkId": "n1", "id": 2, "name": "Data"},
        {"networkId": "n2", "id": 0, "name": "Not routed"},
    ],
    SSID: [{"networkId": "n2", "number": 0, "name": "Guest", "enabled": False, "psk": "12345678", "radiusServers": [{"host": "h", "port": 1812}], "walledGardenRanges": ["r"]}, {"networkId": "n2", "number": 1, "enabled": True}],
    APPLIANCE_MALWARE: [{"networkId": "n1", "mode": "enabled", "allowedUrls": [{"url": "u", "comment": "c"}], "allowedFiles": []}],
}


def land(root, records=RECORDS):
    for spec, items in records.items():
        os.makedirs(f"{root}/{spec.name}", exist_ok=True)
        with open(f"{root}/{spec.name}/part.json", "w") as out:
            out.writelines(json.dumps(i) + "\n" for i in items)
    return str(root)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return land(tmp_path_factory.mktemp("landing"))


def test_raw_shapes(spark, landing):
    take = lambda spec, **f: rows(snapshot(spark, spec, f"{landing}/{spec.name}", **f))
    (org,) = take(ORGANIZATION)
    assert (org["api"], org["licensing"], org["cloud"]) == ('{"enabled":true}', '{"model":"co-term"}', None)
    device = {r["serial"]: r for r in take(DEVICE)}["s1"]
    assert device["details"] == '[{"name":"k","value":"v"}]'
    assert device["beacon_id_params"] == '{"major":1,"minor":2,"uuid":"u"}'
    assert (device["lat"], device["tags"]) == (1.0, ["x"])
    ports = take(SWITCHPORT)
    assert [(p["serial"], p["port_id"], p["vlan"], p["allowed_vlans"]) for p in ports] == [("s1", "10", 0, "443"), ("s1", "2", 5, None)]
    uplinks = take(UPLINK)
    assert [(u["serial"], u["network_id"], u["interface"]) for u in uplinks] == [("s1", "n1", "wan1"), ("s1", "n1", "wan2")]
    alerts = take(ALERT)
    assert (alerts[0]["alert_type"], alerts[0]["network_name"], alerts[0]["scope"]) == ("down", "Main", '{"devices":[{"serial":"s1"}]}')
    rules = take(L3_FIREWALL_RULE)
    assert [(r["rule_order"], r["policy"], r["dest_port"]) for r in rules] == [(0, "deny", "443"), (1, "allow", "Any")]
    vlans = {v["vlan_id"]: v for v in take(VLAN)}
    assert vlans[10]["ipv6"] == '{"enabled":false,"prefixAssignments":[]}'
    assert vlans[2]["name"] == "Data"
    (malware,) = take(APPLIANCE_MALWARE)
    assert (malware["allowed_urls"], malware["allowed_files"]) == ('[{"comment":"c","url":"u"}]', "[]")
    policy = {r["network_id"]: r for r in take(DHCP_SERVER_POLICY)}["n1"]
    assert (policy["blocked_servers"], policy["allowed_servers"]) == (["a"], [])
    ssids = take(SSID, enabled=True)
    assert [s["number"] for s in ssids] == [1]


def test_a_json_array_file(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(RECORDS[NETWORK]))
    assert normalize(read_landing(spark, str(tmp_path), NETWORK, multiline=True), NETWORK).count() == 3


def test_unreadable_record_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"id": "n1", "name": \n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_landing(spark, str(tmp_path), NETWORK).collect()


@pytest.fixture(scope="module")
def tables(spark, landing, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    counts = refresh(spark, landing, root, "2026-01-10")
    return root, counts


def test_refresh_counts(tables):
    _, counts = tables
    inserted = {name: c.get("inserted", c.get("upserted")) for name, c in counts.items()}
    assert inserted == {
        "organization": 1, "network": 3, "device": 3, "switchport": 2, "uplink": 2, "uplink_usage": 1, "alert": 2,
        # Only networks with the product type: n1 for most, n1 and n2 for wireless.
        "dhcp_server_policy": 1, "l3_firewall_rule": 2, "vlan": 2, "ssid": 2, "appliance_malware": 1,
    }


def test_refresh_again(spark, landing, tables):
    root, _ = tables
    counts = refresh(spark, landing, root, "2026-01-20")
    assert all(c.get("inserted", 0) == 0 and c.get("expired+inserted", 0) == 0 for c in counts.values())
    usage = {r["interface"]: (r["sent"], r["received"]) for r in rows(KeyedStore.of(spark, root, UPLINK_USAGE).rows())}
    assert usage == {"wan1": (110, 200), "wan2": (1, 1)}
    # The same refresh again does nothing, and says what it did.
    assert refresh(spark, landing, root, "2026-01-20") == counts
    with pytest.raises(ValueError, match="comes after"):
        refresh(spark, landing, root, "2026-01-15")


def test_reads(spark, tables):
    root, _ = tables
    store = lambda spec: HistoryStore.of(spark, root, spec)
    nets = store(NETWORK).open_rows()
    get = lambda spec, *a, **f: read(spec, store(spec), *a, networks=nets, devices=store(DEVICE).open_rows(), **f).collect()
    ids = lambda found, c="id": [r[c] for r in found]
    assert ids(get(NETWORK)) == ["n2", "n1", "n3"]
    assert ids(get(NETWORK, org_id="o1", name="MAIN")) == ["n1"]
    assert ids(get(NETWORK, product_types_include=["wireless"], tags_exclude=["hq"])) == ["n2"]
    assert ids(get(NETWORK, tags_exclude=["hq"], null_as_empty=False)) == ["n3"]
    assert ids(get(ORGANIZATION, name=" acme ")) == ["o1"]
    assert sorted(ids(get(DEVICE, org_id="o1"), "serial")) == ["s1", "s3"]
    assert ids(get(DEVICE, product_types_include=["switch"]), "serial") == ["s1"]
    assert sorted(ids(get(DEVICE, product_types_exclude=["switch"]), "serial")) == ["s2", "s3"]
    assert ids(get(DEVICE, product_types_exclude=["switch"], null_as_empty=False), "serial") == ["s2"]
    assert ids(get(DEVICE, model="mx"), "serial") == ["s2"]
    # Text order: "10" before "2".
    assert ids(get(SWITCHPORT, serial="s1"), "port_id") == ["10", "2"]
    assert ids(get(SWITCHPORT, vlan=0), "port_id") == ["10"]
    assert ids(get(SWITCHPORT, enabled=False), "port_id") == ["10"]
    assert ids(get(SWITCHPORT, port_type="access", org_id="o1"), "port_id") == ["2"]
    assert get(SWITCHPORT, org_id="o2") == []
    assert ids(get(UPLINK, status="failed", org_id="o1"), "interface") == ["wan2"]
    assert ids(get(UPLINK, ip_assigned_by="dhcp"), "interface") == ["wan1"]
    assert ids(get(ALERT, active_only=True)) == ["a1"]
    assert ids(get(ALERT, severity="warning", alert_type="up")) == ["a2"]
    assert ids(get(L3_FIREWALL_RULE, network_id="n1"), "rule_order") == [0, 1]
    assert ids(get(L3_FIREWALL_RULE, policy="allow"), "rule_order") == [1]
    assert ids(get(VLAN, network_id="n1"), "vlan_id") == [2, 10]
    assert get(VLAN, vlan_id=0) == []
    assert ids(get(SSID, number=0), "name") == ["Guest"]
    assert ids(get(DHCP_SERVER_POLICY, network_id="n1"), "default_policy") == ["block"]
    assert ids(get(APPLIANCE_MALWARE, network_id="n1"), "mode") == ["enabled"]
    usage = KeyedStore.of(spark, root, UPLINK_USAGE)
    assert read(UPLINK_USAGE, usage, now="2026-01-31", org_id="o1", networks=nets, serial="s1").count() >= 1
    assert read(UPLINK_USAGE, usage, month=2, year=2026).count() == 0


def test_argument_checks(spark, tables, landing):
    root, _ = tables
    store = HistoryStore.of(spark, root, DEVICE)
    usage = KeyedStore.of(spark, root, UPLINK_USAGE)
    for call in (
        lambda: read(DEVICE, store, colour="red"),
        lambda: read(DEVICE, store, month=1),
        lambda: read(DEVICE, store, org_id="o1"),
        lambda: read(UPLINK_USAGE, usage, "2026-01-01"),
        lambda: read(UPLINK_USAGE, usage, month=1),
        lambda: snapshot(spark, DEVICE, f"{landing}/device", ts="2026-01-01"),
        lambda: read(SWITCHPORT, HistoryStore.of(spark, root, SWITCHPORT), org_id="o1", networks=store.open_rows()),
        lambda: refresh_levels(["unknown"]),
    ):
        with pytest.raises(ValueError):
            call()


def test_views(spark, tables):
    root, _ = tables
    names = register_views(spark, root, prefix="t_")
    assert len(names) == 12
    assert spark.sql("select count(*) as n from t_device where active_to is null").first().n == 3


def test_usage_straight_from_the_readings(spark, landing):
    events = usage_events(read_landing(spark, f"{landing}/uplink_usage", UPLINK_USAGE))
    got = lambda *a: sorted((r.interface, r.month, r.sent, r.received) for r in usage_of_month(events, *a).collect())
    assert got("2026-01-20") == [("wan1", 1, 110, 200), ("wan2", 1, 1, 1)]
    # From January 9 on: the first reading is too old.
    assert got("2026-02-08", 1) == [("wan1", 1, 10, 0), ("wan2", 1, 1, 1)]
    assert got("2026-02-08") == []


def test_refresh_order():
    names = [[s.name for s in level] for level in refresh_levels()]
    assert names[0] == ["organization"]
    assert set(names[1]) == {"alert", "uplink", "uplink_usage", "device", "switchport", "network"}
    assert set(names[2]) == {"dhcp_server_policy", "l3_firewall_rule", "vlan", "ssid", "appliance_malware"}
    assert [[s.name for s in level] for level in refresh_levels(["vlan"])] == [["vlan"]]
    assert sum(len(level) for level in refresh_levels([])) == len(RESOURCES)


def test_refresh_without_organizations(spark, tmp_path):
    land(tmp_path / "a", {NETWORK: RECORDS[NETWORK]})
    assert refresh(spark, str(tmp_path / "a"), str(tmp_path / "t"), "2026-01-01") == {}
    land(tmp_path / "b", {ORGANIZATION: [], NETWORK: RECORDS[NETWORK]})
    assert refresh(spark, str(tmp_path / "b"), str(tmp_path / "t"), "2026-01-01") == {}


SCHEMA = "k int, v string, active_from timestamp, active_to timestamp, last_seen timestamp"


def new_store(spark, path, buckets=1):
    return HistoryStore(spark, str(path), ["k"], spark.createDataFrame([], SCHEMA).schema, buckets=buckets)


def batch(spark, *items):
    return spark.createDataFrame(list(items), "k int, v string")


@pytest.mark.parametrize("buckets", [1, 8])
def test_commits_and_time_travel(spark, tmp_path, buckets):
    store = new_store(spark, tmp_path / "t", buckets)
    assert store.history().count() == 0 and store.at("2026-01-01").count() == 0
    assert store.merge(batch(spark, (1, "a"), (2, "a")), "2026-01-01") == {"inserted": 2, "updated": 0, "expired+inserted": 0}
    assert store.merge(batch(spark, (1, "b")), "2026-01-02") == {"inserted": 0, "updated": 0, "expired+inserted": 1}
    assert store.merge(batch(spark, (1, "c"), (3, "c")), "2026-01-03", small_bytes=0)["inserted"] == 1
    assert store.merge(batch(spark), "2026-01-04") == {"inserted": 0, "updated": 0, "expired+inserted": 0}
    values = lambda ts: sorted((r.k, r.v) for r in store.at(ts).collect())
    assert values(None) == [(1, "c"), (2, "a"), (3, "c")]
    assert values("2025-12-31") == []
    assert values("2026-01-01") == [(1, "a"), (2, "a")]
    assert values("2026-01-02 12:00:00") == [(1, "b"), (2, "a")]
    assert values(datetime(2026, 1, 3)) == [(1, "c"), (2, "a"), (3, "c")]
    assert len(values("all")) == 5
    with pytest.raises(ValueError, match="not newer"):
        store.merge(batch(spark, (1, "d")), "2026-01-03")


def test_as_of_reads_only_later_commits(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    for day, v in enumerate("abcd", 1):
        store.merge(batch(spark, (1, v)), f"2026-01-0{day}")
    late = store.closed_rows(after="2026-01-03")
    assert len(late.inputFiles()) == 1 and [r.v for r in late.collect()] == ["c"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_unfinished_commit_is_not_seen(spark, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    store = new_store(spark, tmp_path / "t")
    store.merge(batch(spark, (1, "a")), "2026-01-01")
    # A run that died after writing data: its folder has no commit marker.
    ghost = store.open_rows().withColumn("v", F.lit("ghost")).withColumn("_part", F.lit("closed"))
    ghost.withColumn("_bucket", F.lit(0)).write.partitionBy("_part", "_bucket").parquet(store._data("0000000001-died"))
    assert [r.v for r in store.history().collect()] == ["a"]
    store.merge(batch(spark, (1, "b")), "2026-01-02")
    assert sorted(r.v for r in store.history().collect()) == ["a", "b"]
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_buckets_limit_a_merge(spark, tmp_path):
    store = new_store(spark, tmp_path / "t", 16)
    store.merge(batch(spark, *[(k, "a") for k in range(200)]), "2026-01-01")
    first = store.state()[1]["open"]
    assert set(first) == {str(b) for b in range(16)} and len(set(first.values())) == 1
    store.merge(batch(spark, (7, "b")), "2026-01-02")
    ((changed, folder),) = set(store.state()[1]["open"].items()) - set(first.items())
    assert os.listdir(f"{store._data(folder)}/_part=open") == [f"_bucket={changed}"]
    assert len(store.open_rows(key=7).inputFiles()) < len(store.open_rows().inputFiles())
    assert [r.v for r in store.open_rows(key=7).where("k = 7").collect()] == ["b"]
    assert store.open_rows().count() == 200 and store.history().count() == 201
    log = spark.createDataFrame([(7, "c", datetime(2026, 1, 3)), (7, "b", datetime(2026, 1, 4))], "k int, v string, t timestamp")
    store.merge_log(log, "t")
    assert sorted(r.v for r in store.history().where("k = 7").collect()) == ["a", "b", "b", "c"]
    assert store.open_rows().count() == 200
    # Of the last commit's buckets, 15 still lie in the first commit.
    assert store.drop_old(keep=1) == 2
    assert store.open_rows().count() == 200
    with pytest.raises(ValueError, match="buckets"):
        new_store(spark, tmp_path / "t", 8).open_rows()


@pytest.mark.parametrize("buckets", [1, 4])
def test_load_a_history_and_evolve_it(spark, tmp_path, buckets):
    old = new_store(spark, tmp_path / "old")
    old.merge(batch(spark, (1, "7"), (2, "8")), "2026-01-01")
    old.merge(batch(spark, (1, "9")), "2026-01-02")
    steps = [Rename("v", "n"), Cast("n", "int"), Add("psk")]
    moved = upgrade(old.history(), steps)
    order = ["k", "n", "psk", "active_from", "active_to", "last_seen"]
    new = HistoryStore(spark, str(tmp_path / "new"), ["k"], moved.select(*order).schema, buckets=buckets)
    new.load(moved, "2026-01-02")
    assert sorted((r.k, r.n) for r in new.at("2026-01-01").collect()) == [(1, 7), (2, 8)]
    assert sorted((r.k, r.n) for r in new.open_rows().collect()) == [(1, 9), (2, 8)]
    same = spark.createDataFrame([(1, 9, None)], "k int, n int, psk string")
    assert new.merge(same, "2026-01-03") == {"inserted": 0, "updated": 1, "expired+inserted": 0}
    with pytest.raises(ValueError):
        new.load(moved, "2026-01-04")


def test_redelivered_batch_counts_once(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    first = store.merge(batch(spark, (1, "a")), "2026-01-01", source=("s", 3))
    assert store.merge(batch(spark, (1, "a")), "2026-01-05", source=("s", 3)) == first
    with pytest.raises(ValueError, match="comes after"):
        store.merge(batch(spark, (1, "a")), "2026-01-05", source=("s", 2))
    assert [str(r.last_seen) for r in store.open_rows().collect()] == ["2026-01-01 00:00:00"]


def test_two_writers_of_one_commit(spark, tmp_path):
    one, two = new_store(spark, tmp_path / "t"), new_store(spark, tmp_path / "t")
    one.merge(batch(spark, (1, "a")), "2026-01-01")
    number, body = two.state()
    one.merge(batch(spark, (1, "b")), "2026-01-02")
    with pytest.raises(Exception, match="exists"):
        two._commit(scd2_merge(two.open_rows(), batch(spark, (1, "c")), ["k"], ["v"], "2026-01-02"), number, body, 1, {0}, None)
    assert sorted(r.v for r in two.history().collect()) == ["a", "b"]


def test_an_unfinished_marker_is_passed_over(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    store.merge(batch(spark, (1, "a")), "2026-01-01")
    (tmp_path / "t" / "commits" / "0000000001").write_text('{"time": 1')
    assert [r.v for r in store.history().collect()] == ["a"]
    store.merge(batch(spark, (1, "b")), "2026-01-02")
    assert store.commits.numbers() == [0, 1, 2] and sorted(r.v for r in store.history().collect()) == ["a", "b"]


def test_a_refresh_that_died_halfway(spark, tmp_path):
    land(tmp_path / "l", {ORGANIZATION: RECORDS[ORGANIZATION], NETWORK: RECORDS[NETWORK]})
    root = str(tmp_path / "t")
    first = refresh(spark, str(tmp_path / "l"), root, "2026-01-01", ["organization"])
    again = refresh(spark, str(tmp_path / "l"), root, "2026-01-01")
    assert again["organization"] == first["organization"] and again["network"]["inserted"] == len(RECORDS[NETWORK])
    assert HistoryStore.of(spark, root, ORGANIZATION).commits.numbers() == [0]


def test_streams_follow_on_whatever_is_there(spark, tmp_path):
    """A merge before the stream, and a new checkpoint: no batch is taken for one that is done."""
    store = new_store(spark, tmp_path / "t")
    store.merge(batch(spark, (1, "a")), "2026-01-01")
    schema, source = "k int, v string, t timestamp", str(tmp_path / "s")
    for n, checkpoint in enumerate(("one", "two")):
        folder = f"{source}/{n}"
        spark.createDataFrame([(2, f"b{n}", datetime(2026, 1, 2 + n))], schema).write.parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        for _ in range(2):
            stream_log(stream, store, "t", checkpoint=str(tmp_path / checkpoint)).awaitTermination()
    assert sorted(r.v for r in store.history().collect()) == ["a", "b0", "b1"]


def test_load_refuses_a_history_that_goes_on(spark, tmp_path):
    old = new_store(spark, tmp_path / "old")
    old.merge(batch(spark, (1, "a")), "2026-01-01")
    old.merge(batch(spark, (1, "b")), "2026-01-03")
    with pytest.raises(ValueError, match="goes on after"):
        new_store(spark, tmp_path / "new").load(old.history(), "2026-01-02")


def test_drop_old(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    for day, v in enumerate("abcd", 1):
        store.merge(batch(spark, (1, v)), f"2026-01-0{day}")
    assert store.drop_old(keep=1) == 3
    assert store.history().count() == 4
    assert [r.v for r in store.at("2026-01-02").collect()] == ["b"]


def test_everything_closed_leaves_no_open_rows(spark, tmp_path):
    log = spark.createDataFrame([(1, "a", datetime(2026, 1, 1))], "k int, v string, t timestamp")
    store = new_store(spark, tmp_path / "t")
    store.merge_log(log, "t")
    assert store.merge_log(log.limit(0), "t") == {"inserted": 0, "updated": 0, "expired+inserted": 0}
    with pytest.raises(ValueError, match="older"):
        store.merge_log(log.withColumn("t", F.col("t") - F.expr("interval 1 day")), "t")


def test_keyed_store(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, month int, n bigint, last_seen timestamp").schema
    store = KeyedStore(spark, str(tmp_path / "t"), ["k", "month"], schema, ["month"])
    load = lambda *items: spark.createDataFrame(list(items), "k int, month int, n bigint")
    assert store.rows().count() == 0
    assert store.upsert(load((1, 1, 10), (1, 2, 20)), "2026-01-01") == {"upserted": 2}
    assert store.upsert(load((1, 2, 21), (2, 2, 22)), "2026-01-02") == {"upserted": 2}
    assert store.upsert(load(), "2026-01-03") == {"upserted": 0}
    got = sorted((r.k, r.month, r.n) for r in store.rows().collect())
    assert got == [(1, 1, 10), (1, 2, 21), (2, 2, 22)]
    # January was not written again.
    assert len(store.rows(month=1).inputFiles()) == 1 and store.rows(month=1).inputFiles() != store.rows(month=2).inputFiles()
    with pytest.raises(ValueError):
        store.rows(k=1)
    with pytest.raises(ValueError, match="key"):
        KeyedStore(spark, str(tmp_path / "x"), ["k"], schema, ["month"])
    flat = KeyedStore(spark, str(tmp_path / "f"), ["k", "month"], schema)
    flat.upsert(load((1, 1, 10)), "2026-01-01")
    flat.upsert(load((1, 1, 11), (2, 1, 1)), "2026-01-02")
    assert sorted((r.k, r.n) for r in flat.rows().collect()) == [(1, 11), (2, 1)]


def test_stream_of_snapshots(spark, tmp_path):
    store = HistoryStore.of(spark, str(tmp_path / "t"), NETWORK)
    root = str(tmp_path / "landing")
    times = ["2026-01-01", "2026-01-02", "2026-01-03"]

    def run():
        stream = normalize(stream_landing(spark, f"{root}/network", NETWORK), NETWORK)
        stream_snapshots(stream, store, lambda n: times[n]).awaitTermination()

    land(root, {NETWORK: RECORDS[NETWORK]})
    run()
    renamed = [{**RECORDS[NETWORK][0], "name": "renamed"}]
    os.makedirs(f"{root}/network", exist_ok=True)
    with open(f"{root}/network/second.json", "w") as out:
        out.write(json.dumps(renamed[0]))
    run()
    run()
    assert store.history().count() == 4
    assert [r.name for r in store.at().where("id = 'n1'").collect()] == ["renamed"]
    assert store.commits.numbers() == [0, 1]


def test_stream_of_timed_snapshots(spark, tmp_path):
    """Snapshots that carry their own time; two of them land at once."""
    store = HistoryStore.of(spark, str(tmp_path / "t"), DEVICE, buckets=4)
    os.makedirs(tmp_path / "landing")
    with open(tmp_path / "landing" / "all.json", "w") as out:
        for day, status in ((1, "online"), (2, "online"), (3, "offline")):
            out.write(json.dumps({"serial": "s1", "status": status, "takenAt": f"2026-01-0{day}T00:00:00Z"}) + "\n")
    raw = stream_landing(spark, str(tmp_path / "landing"), DEVICE, extra="takenAt timestamp")
    stream_log(normalize(raw, DEVICE, keep=["takenAt"]), store, "takenAt").awaitTermination()
    got = [(r.status, str(r.active_from)[:10], str(r.last_seen)[:10]) for r in store.history().orderBy("active_from").collect()]
    assert got == [("online", "2026-01-01", "2026-01-02"), ("offline", "2026-01-03", "2026-01-03")]


def test_stream_log_refuses_old_batches(spark, tmp_path):
    store = new_store(spark, tmp_path / "t")
    source = str(tmp_path / "source")
    schema = "k int, v string, t timestamp"

    def run(*items):
        spark.createDataFrame(list(items), schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        stream_log(stream, store, "t").awaitTermination()

    run((1, "a", datetime(2026, 1, 2)), (1, "b", datetime(2026, 1, 3)))
    assert store.history().count() == 2
    with pytest.raises(Exception, match="older than the last commit"):
        run((1, "c", datetime(2026, 1, 1)))


def test_stream_counters_sets_late_events_aside(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, month int, year int, n bigint, last_seen timestamp").schema
    store = KeyedStore(spark, str(tmp_path / "t"), ["k", "month", "year"], schema, ["year", "month"])
    source, late = str(tmp_path / "source"), []
    events = [(1, datetime(2026, 1, 31), 1), (1, datetime(2026, 2, 1), 2), (1, datetime(2025, 12, 1), 4)]
    spark.createDataFrame(events, "k int, t timestamp, n bigint").write.parquet(source)
    stream = spark.readStream.schema("k int, t timestamp, n bigint").parquet(source)
    query = stream_counters(stream, store, ["n"], "t", "2026-02-10", late=lambda df, _: late.extend(df.collect()))
    query.awaitTermination()
    assert sorted((r.year, r.month, r.n) for r in store.rows().collect()) == [(2026, 1, 1), (2026, 2, 2)]
    assert [r.n for r in late] == [4]


def test_late_and_untimed_events_are_kept(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, month int, year int, n bigint, last_seen timestamp").schema
    store = KeyedStore(spark, str(tmp_path / "t"), ["k", "month", "year"], schema, ["year", "month"])
    events = spark.createDataFrame([(1, datetime(2026, 2, 1), 2), (1, datetime(2025, 12, 1), 4), (1, None, 8)], "k int, t timestamp, n bigint")
    assert late_events(store, events).count() == 0
    events.write.parquet(str(tmp_path / "source"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "source"))
    stream_counters(stream, store, ["n"], "t", "2026-02-10").awaitTermination()
    assert [r.n for r in store.rows().collect()] == [2]
    assert sorted(r.n for r in late_events(store, events).collect()) == [4, 8]


def test_session_settings(spark, tmp_path):
    assert session().conf.get("spark.sql.adaptive.enabled") == "true"
    assert shared_dir(spark) == shared_dir(spark)
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(100 * 2**40) == 100 * 2**40 // (256 * 2**20)
