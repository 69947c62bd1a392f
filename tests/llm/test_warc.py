"""WARC derivatives: what they refer to and hold, and files read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib

from palimpsest.llm import warc


def sha(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_pages_to_derivatives(spark):
    pages = [(1, "http://a", "<p>One<p>Té"), (2, None, None), (3, "http://c", ""), (3, "http://c", ""), (None, "u", "x")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, block string")
    source = warc.responses(df, "2024-01-01T00:00:00Z")
    by_id = {r["record_id"]: r for r in source.collect()}
    got = warc.derive(source).collect()
    assert sorted(r["record_type"] for r in got) == ["conversion"] * 5 + ["metadata"] * 5
    for r in got:
        of = by_id[r["fields"]["WARC-Refers-To"]]
        assert r["record_id"] != of["record_id"] and r["target_uri"] == of["target_uri"]
        assert r["fields"]["WARC-Refers-To-Date"] == of["record_date"] == r["record_date"]
        assert r["fields"]["WARC-Block-Digest"] == sha(bytes(r["block"]))
        if r["record_type"] == "metadata":
            told = json.loads(r["block"])
            assert told["digests"]["match"] and told["digests"]["recorded"] == told["digests"]["computed"]
            assert told["source"]["WARC-Payload-Digest"] == of["fields"]["WARC-Payload-Digest"]
            assert told["http"]["headers"][0] == ["Content-Type", "text/html; charset=utf-8"]
            assert told["conversion"] in {x["record_id"] for x in got if x["record_type"] == "conversion"}
    texts = {r["target_uri"]: bytes(r["block"]).decode() for r in got if r["record_type"] == "conversion"}
    assert texts == {"http://a": "One\n\nTé", None: "", "http://c": "", "u": "x"}
    assert warc.derive(source.limit(0)).count() == 0


def record(block, **kw):
    base = {"record_type": "response", "record_id": "<a>", "target_uri": "u", "record_date": "d", "fields": {}, "block": block}
    return base | kw


def http(headers: str, body: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\n" + headers.replace("\n", "\r\n").encode() + b"\r\n\r\n" + body


def test_codings_and_types():
    def text(block):
        found = [r for r in warc._derived(record(block)) if r["record_type"] == "conversion"]
        return found[0]["block"].decode() if found else None

    assert text(http("Content-Type: text/html", b"<p>a")) == "a"
    assert text(http("Content-Type: text/plain", b"<p>a")) == "<p>a"
    assert text(http("Content-Type: image/png", b"<p>a")) is None
    assert text(http("content-type: TEXT/HTML; charset=latin-1\nX: a\n b", "é".encode("latin-1"))) == "é"
    assert text(http("Content-Encoding: gzip", gzip.compress(b"<b>z"))) == "z"
    assert text(http("Content-Encoding: gzip", b"not gzipped")) == "not gzipped"
    assert text(http("Transfer-Encoding: chunked", b"2\r\nab\r\n1;x\r\nc\r\n0\r\n\r\n")) == "abc"
    assert text(http("Content-Type: text/html; charset=nonsense", b"x")) == "x"
    assert text(b"") == "" and text(b"<p>no head") == "no head"


def test_codings_that_are_broken_or_unknown():
    def told(headers, data):
        rows = warc._derived(record(http(headers, data)))
        return [r["block"].decode() for r in rows[1:]], json.loads(rows[0]["block"])["whole"]

    two = gzip.compress(b"one ") + gzip.compress(b"two")
    assert told("Content-Encoding: gzip", two) == (["one two"], True)
    (cut,), whole = told("Content-Encoding: gzip", two[:-12])
    assert cut.startswith("one") and not whole
    raw = zlib.compressobj(wbits=-15)
    assert told("Content-Encoding: deflate", raw.compress(b"<p>raw") + raw.flush()) == (["raw"], True)
    assert told("Content-Encoding: deflate", zlib.compress(b"<p>wrapped")) == (["wrapped"], True)
    assert told("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(b"both"))) == (["both"], True)
    assert told("Content-Encoding: br", b"\x0b\x02\x80hello\x03") == ([], True)
    assert told("Content-Encoding: gzip", b"<p>plain") == (["plain"], False)
    assert told("Transfer-Encoding: chunked", b"2\r\nab\r\n0\r\n\r\n") == (["ab"], True)
    assert told("Transfer-Encoding: chunked", b"2\r\nab\r\n9\r\ncd") == (["abcd"], False)
    assert told("Transfer-Encoding: chunked", b"2\r\nab?rest") == (["ab?rest"], False)
    long = bytes(range(65, 91)) * 20_000
    cut, whole = told("Content-Type: text/plain\nContent-Encoding: gzip", gzip.compress(long)[:-20])
    assert not whole and long.startswith(cut[0].encode()) and cut[0]


def test_one_pass_gives_the_same(spark):
    pages = [(1, "http://a", "<p>One<p>Té"), (2, None, None), (3, "http://c", ""), (3, "http://c", ""), (None, "u", "x" * 5_000_000)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, warc string").repartition(2)
    names = [n for n in warc.RECORD.names if n != "block"]
    steps = warc.serialise(warc.derive(warc.responses(df, "d"))).selectExpr(*names, "cast(length(block) as long) as block_bytes", "warc")
    one = warc.archive(df, "d")
    assert one.columns == steps.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, steps.collect()))
    assert warc.archive(df.limit(0), "d").count() == 0


def test_records_behind_broken_ones():
    def whole(name, block=b"block"):
        return warc.record_bytes(record(block, record_id=name) | {"fields": []})

    def read(data):
        return [(r["record_id"], r["block"], "WARC-Truncated" in r["fields"]) for r in warc.records_in(data)]

    a, b, c = whole("a"), whole("b"), whole("c")
    assert read(a + b + c) == [("a", b"block", False), ("b", b"block", False), ("c", b"block", False)]
    # No length, a length that is no number, too long or too short a one, and a file that ends inside a block.
    assert read(a.replace(b"Content-Length: 5", b"X: y") + b) == [("a", b"block", True), ("b", b"block", False)]
    for length in (b"five", b"-5", b"500000", b"3"):
        assert read(a.replace(b"Length: 5", b"Length: " + length) + b) == [("a", b"block", True), ("b", b"block", False)]
    assert read(a + b[:-6]) == [("a", b"block", False), ("b", b"blo", True)]
    assert read(b"junk\r\n" + a + b"junk\r\n" + b) == [("a", b"block", False), ("b", b"block", False)]
    # Gzipped members: a broken one in the middle costs no other.
    packed = [gzip.compress(x) for x in (a, b, c)]
    assert read(b"".join(packed)) == read(a + b + c)
    around = read(packed[0] + packed[1][:40] + packed[2])
    assert around[0] == ("a", b"block", False) and around[-1] == ("c", b"block", False)


def test_wrong_digests_show():
    fields = {"WARC-Payload-Digest": sha(b"other")}
    told = json.loads(warc._derived(record(http("X: y", b"a"), fields=fields))[0]["block"])
    assert not told["digests"]["match"] and told["digests"]["recorded"] == fields


def test_files_read_back(spark, tmp_path):
    rows = [record(b"a\r\n\r\nWARC/1.1\r\n"), record(b"", record_type="request", target_uri=None), record(None, fields=None, record_date=None)]
    rows[0]["fields"] = {"WARC-Block-Digest": "x", "Other": "two\r\nlines"}
    df = spark.createDataFrame(rows, warc.RECORD)
    for packed, name in [(False, "a.warc"), (True, "b.warc.gz")]:
        data = b"".join(bytes(r["warc"]) for r in warc.serialise(df.coalesce(1), packed).collect())
        (tmp_path / name).write_bytes(data)
        back = sorted(warc.read(spark, str(tmp_path / name)).collect(), key=lambda r: -len(r["block"]))
        assert [bytes(r["block"]) for r in back] == [b"a\r\n\r\nWARC/1.1\r\n", b"", b""]
        assert back[0]["fields"] == {"WARC-Block-Digest": "x", "Other": "two lines"}
        assert {r["record_type"] for r in back} == {"response", "request"}
        # Derivatives of other types there are none.
        assert warc.derive(warc.read(spark, str(tmp_path / name))).where("record_type = 'metadata'").count() == 2
    assert list(warc.records_in(data[: len(data) // 2])) is not None
    assert list(warc.records_in(b"no warc")) == []
