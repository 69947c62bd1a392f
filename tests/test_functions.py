"""Column functions: names, canonical values, equality, predicates, times, units."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions import predicates as P
from palimpsest.functions.canonical import json_canonical, json_value, same
from palimpsest.functions.casing import camel, camel_values, snake, snake_values
from palimpsest.functions.times import moment, position
from palimpsest.functions.units import gigabytes

# Words joined both ways; a capital always begins a word, digits and leading underscores never do.
WORDS = [["a"], ["x", "y", "z"], ["wan1", "ip4"], ["lease", "2days"], ["repeat", "repeat"], ["", "hidden", "column"]]
NAMES = [(w[0] + "".join(x[:1].upper() + x[1:] for x in w[1:]), "_".join(w)) for w in WORDS if w[-1] != "2days"]
NAMES = [(raw, "hidden_column" if raw == "HiddenColumn" else name) for raw, name in NAMES]
NAMES += [("lease2days", "lease2days"), ("already_snake", "already_snake"), ("ABC", "a_b_c"), ("_Led", "__led")]


def test_names(spark):
    assert [snake(raw) for raw, _ in NAMES] == [s for _, s in NAMES]
    got = spark.createDataFrame(NAMES, "raw string, snake string").select(
        snake_values(F.col("raw")).alias("s"), "snake", camel_values(F.col("snake")).alias("c")
    )
    for row in got.collect():
        assert row.s == row.snake
        assert row.c == camel(row.snake)
    assert all(snake(camel("_".join(w))) == "_".join(w) for w in WORDS if w[0] and w[-1] != "2days")


EQUAL_JSON = [
    ('{"a":1,"b":"x"}', '{"a":1,"b":"x"}', True),
    ('{"a":1,"b":2}', '{ "b": 2, "a": 1 }', True),
    ('{"a":{"y":1,"x":2}}', '{"a":{"x":2,"y":1}}', True),
    ('{"a":1}', '{"a":2}', False),
    ('{"a":1}', '{"b":1}', False),
    ('{"k": "v"}', '{"k":"v"}', True),
    ("[1, 2]", "[1,2]", True),
    ("[1, 2]", "[2,1]", False),
    ("1.0", "1", True),
    (None, None, True),
    (None, '"something"', False),
    (None, "[]", True),
    ("{}", None, True),
    (None, '["x"]', False),
    ("[]", "[null]", False),
    ('{"a":[]}', '{"a":null}', False),
    ("not json", "not json", True),
    ("not json", "different", False),
]


def test_json_equality(spark):
    df = spark.createDataFrame(EQUAL_JSON, "l string, r string, want boolean")
    got = df.select("l", "r", "want", same(F.col("l"), F.col("r"), T.StringType(), True).alias("got"))
    assert [(r.l, r.r, r.got) for r in got.collect()] == [(r.l, r.r, r.want) for r in df.collect()]


def test_plain_text_is_never_parsed(spark):
    df = spark.createDataFrame([("443", "443"), ("443", "443.0"), ('{"a":1}', '{ "a":1}')], "l string, r string")
    got = df.select(same(F.col("l"), F.col("r"), T.StringType()).alias("got"))
    assert [r.got for r in got.collect()] == [True, False, False]


def test_array_and_map_equality(spark):
    df = spark.createDataFrame(
        [(None, []), ([], None), (["x"], None), (["a", "b"], ["b", "a"]), (["a"], ["a"])],
        "l array<string>, r array<string>",
    )
    kind = T.ArrayType(T.StringType())
    got = df.select(same(F.col("l"), F.col("r"), kind).alias("got"))
    assert [r.got for r in got.collect()] == [True, True, False, False, True]
    maps = spark.createDataFrame(
        [({"a": 1, "b": 2}, {"b": 2, "a": 1}), ({}, None), ({"a": 1}, {"a": 2})],
        "l map<string,int>, r map<string,int>",
    )
    kind = T.MapType(T.StringType(), T.IntegerType())
    got = maps.select(same(F.col("l"), F.col("r"), kind).alias("got"))
    assert [r.got for r in got.collect()] == [True, True, False]


def test_json_canonical_of_empties(spark):
    df = spark.createDataFrame([("[ ]",), ("{}",), ("null",), ("[0]",)], "j string")
    got = [r[0] for r in df.select(json_canonical(F.col("j"))).collect()]
    assert got == [None, None, None, "[0]"]


def test_json_value(spark):
    df = spark.createDataFrame([('a"b', 1, True, ["x"], None)], "s string, i int, b boolean, a array<string>, n string")
    got = df.select(*[json_value(F.col(c)).alias(c) for c in df.columns]).first()
    assert tuple(got) == ('"a\\"b"', "1", "true", '["x"]', "null")


SETS = [None, [], [None], ["p"], ["q", "p"], ["r", None], ["p", "q", "r"], ["P"]]


def test_tags(spark):
    """Every set against every pair of wanted and unwanted tags, by the rule."""
    df = spark.createDataFrame(list(enumerate(SETS)), "i int, t array<string>")
    lists = [[], ["p"], ["q", "r"], ["p", "p"]]
    for include in lists:
        for exclude in lists:
            got = {r.i for r in df.where(P.tags(F.col("t"), include, exclude)).collect()}
            held = [set(x or []) for x in SETS]
            assert got == {i for i, h in enumerate(held) if set(include) <= h and not set(exclude) & h}


def test_null_tags_unknown(spark):
    df = spark.createDataFrame([(None,), (["a"],)], "t array<string>")
    assert df.where(P.has_none(F.col("t"), ["b"], null_as_empty=False)).count() == 1
    assert df.where(P.has_all(F.col("t"), ["a"], null_as_empty=False)).count() == 1


def test_text(spark):
    df = spark.createDataFrame([("100% Sure",), ("100 sure",), (" Padded ",)], "n string")
    count = lambda c: df.where(c).count()
    assert count(P.text(F.col("n"), "100% s")) == 1
    assert count(P.text(F.col("n"), "100%s", match="pattern")) == 2
    assert count(P.text(F.col("n"), "")) == 3
    assert count(P.text(F.col("n"), "  padded ", strip=True)) == 1
    with pytest.raises(ValueError):
        P.text(F.col("n"), "x", match="regex")


def test_prefixes(spark):
    df = spark.createDataFrame([("MX64",), ("ms120",), ("MR33",), (None,), ("CW9166",)], "m string")
    got = lambda c: sorted(str(r.m) for r in df.where(c).collect())
    assert got(P.prefix_any(F.col("m"), ["switch", "wireless"])) == ["MR33", "ms120"]
    assert len(got(P.prefix_any(F.col("m"), ["camera"]))) == 5
    assert got(P.prefix_none(F.col("m"), ["appliance", "switch"])) == ["CW9166", "MR33", "None"]
    assert got(P.prefix_none(F.col("m"), ["appliance"], null_as_empty=False)) == ["CW9166", "MR33", "ms120"]


def test_times(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",), ("2024-03-31 03:15:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = [r[0] for r in df.select(position(F.col("t"), T.TimestampNTZType())).collect()]
        assert got[1] - got[0] == 45 * 60 * 1_000_000
        both = spark.range(1).select(
            moment("2024-01-01 00:00:00").alias("a"), moment("2024-01-01T02:00:00+02:00").alias("b")
        )
        assert both.select(F.col("a") == F.col("b")).first()[0]
        assert both.select(F.unix_seconds("a")).first()[0] == 1704067200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_gigabytes(spark):
    df = spark.createDataFrame([(1073741824,), (5368710,), (None,), (9223372036854775807,)], "b bigint")
    got = [None if r[0] is None else float(r[0]) for r in df.select(gigabytes(F.col("b"))).collect()]
    assert got == [1.0, 0.01, None, 8589934592.0]
