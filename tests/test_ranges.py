"""Addresses of both families, longest prefixes, and sets of intervals."""

from __future__ import annotations

import ipaddress
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from palimpsest.functions.addresses import address_number, prefix_of
from palimpsest.operators.intervals import merged, plan_reads, subtract
from palimpsest.operators.prefixes import fill_by_prefix, prefix_lookup


def number(text):
    try:
        ip = ipaddress.ip_address((text or "").strip())
    except ValueError:
        return None
    if ip.version == 4:
        return (0xFFFF << 32) | int(ip)
    return None if "%" in text else int(ip)


def halves(n):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return None if n is None else (signed(n >> 64), signed(n & ((1 << 64) - 1)))


def addresses(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        ip = ipaddress.IPv6Address(rng.choice([rng.getrandbits(128), rng.getrandbits(20), 0x20010DB8 << 96 | rng.getrandbits(16), rng.getrandbits(48) << 80]))
        v4 = ipaddress.IPv4Address(rng.getrandbits(32))
        forms = [ip.compressed, ip.exploded, ip.compressed.upper(), f"  {ip} ", str(v4), f"::ffff:{v4}", f"64:ff9b::{v4}"]
        out.append(rng.choice(forms))
    return out


ODD = [
    None, "", ":", "::", ":::", "1::", "::1", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "1:2:3:4::5:6:7:8", "12345::", "g::", "fe80::1%eth0", "[::1]", "::ffff:1.2.3.256", "::1.2.3", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "1:2:3:4:5:6:7:1.2.3.4",
    "1:2:3:4:5:6:1.2.3.4", "::1.2.3.4", "1.2.3.4:5", "a.b.c.d", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "ABCD:EF01::",
]


def test_addresses_as_numbers(spark):
    some = [*ODD, *addresses(1, 400)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "i int, t string").select("i", address_number(F.col("t")).alias("n"))
    for r in got.collect():
        assert (r.n and tuple(r.n)) == halves(number(some[r.i])), some[r.i]


def test_prefixes_of_every_length(spark):
    rng = random.Random(2)
    rows = [(n, str(ipaddress.IPv6Address(rng.getrandbits(128)))) for n in range(129)]
    got = spark.createDataFrame(rows, "n int, t string").select("n", "t", prefix_of(address_number(F.col("t")), F.col("n")).alias("p"))
    for r in got.collect():
        kept = int(ipaddress.IPv6Address(r.t)) >> (128 - r.n) << (128 - r.n)
        assert tuple(r.p) == halves(kept)


def test_longest_prefix_by_brute_force(spark):
    rng = random.Random(3)
    points = [*addresses(4, 150), *ODD, *[f"10.{rng.randrange(4)}.0.{rng.randrange(9)}" for _ in range(60)]]
    points += [f"::ffff:10.{rng.randrange(4)}.0.{rng.randrange(9)}" for _ in range(20)]
    prefixes = [("10.0.0.0", 8, "ten", 1), ("10.1.0.9", 16, "one", 1), ("10.1.0.4", 32, "host", 1), ("::", 0, "all", 1), ("2001:db8::", 32, "doc", 1)]
    prefixes += [("2001:DB8::1", 128, "a", 2), ("2001:db8:0::1", 128, "b", 1), ("10.2.0.0", 33, "no", 1), ("x", 3, "no", 1), (None, 1, "no", 1), ("10.3.0.0", -1, "no", 1)]
    points.append("2001:db8::1")

    def best(text):
        n = number(text)
        if n is None:
            return None
        found = []
        for net, length, value, rank in prefixes:
            at = number(net)
            bits = length + 96 if net and "." in net else length
            if at is not None and 0 <= length and bits <= 128 and n >> (128 - bits) == at >> (128 - bits):
                found.append((bits, rank, value))
        return max(found)[2] if found else None

    held = spark.createDataFrame(prefixes, "net string, len int, who string, rank int")
    asked = spark.createDataFrame([(p,) for p in [*points, *points]], "ip string")
    got = {r.ip: r.who for r in prefix_lookup(asked, held, "ip", "net", "len", "who", "rank").collect()}
    assert got == {p: best(p) for p in points if best(p) is not None}
    rows = [(i, p, "kept" if i % 3 == 0 else None) for i, p in enumerate(points)]
    filled = fill_by_prefix(spark.createDataFrame(rows, "i int, ip string, who string"), held, "ip", "net", "len", "who", "rank")
    assert {r.i: r.who for r in filled.collect()} == {i: w or best(p) for i, p, w in rows}
    assert prefix_lookup(asked, held.limit(0), "ip", "net", "len", "who").count() == 0


DAY = datetime(2026, 1, 1)


def hours(spark, rows):
    made = [(g, None if a is None else DAY + timedelta(hours=a), None if b is None else DAY + timedelta(hours=b)) for g, a, b in rows]
    return spark.createDataFrame(made, "g string, t0 timestamp, t1 timestamp")


def as_hours(df, *more):
    back = lambda t: int((t - DAY).total_seconds() // 3600)
    return sorted((r.g, back(r.t0), back(r.t1), *[r[m] for m in more]) for r in df.collect())


def covered(rows, g):
    return {h for k, a, b in rows if k == g and a is not None and b is not None for h in range(a, b)}


def as_intervals(g, held):
    out = []
    for h in sorted(held):
        if out and out[-1][2] == h:
            out[-1] = (g, out[-1][1], h + 1)
        else:
            out.append((g, h, h + 1))
    return out


def some_intervals(rng, n):
    rows = [(rng.choice("ab"), a := rng.randrange(40), a + rng.randrange(-2, 8)) for _ in range(n)]
    return rows + rows[:2] + [("a", None, 3), ("b", 5, None), ("c", 4, 4)]


def test_sets_by_brute_force(spark):
    rng = random.Random(5)
    for n in (0, 1, 4, 12):
        mine, theirs = some_intervals(rng, n), some_intervals(rng, n)
        union = [i for g in "abc" for i in as_intervals(g, covered(mine, g))]
        assert as_hours(merged(hours(spark, mine), ["g"], "t0", "t1")) == union
        rest = [i for g in "abc" for i in as_intervals(g, covered(mine, g) - covered(theirs, g))]
        assert as_hours(subtract(hours(spark, mine), hours(spark, theirs), ["g"], "t0", "t1")) == rest


def test_what_is_still_to_be_read(spark):
    """Windows that overlap, repeat, failed between others, lie before the limit, and groups without any."""
    reads = [("a", 0, 10), ("a", 8, 20), ("a", 8, 20), ("a", 30, 40), ("b", 0, 2), ("c", 5, 5)]
    groups = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "g string")
    now = DAY + timedelta(hours=50)
    got = plan_reads(groups, hours(spark, reads), ["g"], now, "30 hours", "6 hours")
    assert as_hours(got, "state") == [
        ("a", 20, 26, "next"), ("a", 26, 30, "open"), ("a", 40, 50, "open"),
        ("b", 2, 20, "lost"), ("b", 20, 26, "next"), ("b", 26, 50, "open"),
        ("c", 20, 26, "next"), ("c", 26, 50, "open"),
    ]
    # Reading what is next, again and again, reads every hour once and ends.
    read = reads
    for _ in range(30):
        todo = [(g, a, b) for g, a, b, state in as_hours(plan_reads(groups, hours(spark, read), ["g"], now, "30 hours", "12 hours"), "state") if state == "next"]
        if not todo:
            break
        assert not any(covered([w], w[0]) & covered(read, w[0]) for w in todo)
        read = read + todo
    assert covered(read, "a") == set(range(50)) and covered(read, "c") == set(range(20, 50))
