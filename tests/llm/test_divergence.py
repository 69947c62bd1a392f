"""The audit against plain Python integers, and its parts against their definitions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from palimpsest.llm import divergence, queries

SCHEMA = "doc_id long, text string, lang string, source string, value long, term string"


def by_definition(docs, least, top):
    count, found, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in terms]
        count[lang, source].update(terms)
        found[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in found[lang].items() if n >= least]
        v = len(kept)
        cells = {s: {t: count[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(c[t] for c in cells.values()) for t in kept}

        def shares(c):
            total = sum(c.values())
            return {t: 1 + 10**9 * (n + 2) // (total + 2 * v) for t, n in c.items()}

        q = shares(whole)
        p = {s: shares(c) for s, c in cells.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if cells[s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]):
                    out.append((lang, s, part, item, value, k + 1))
    return sorted(out)


def documents(seed, n=250):
    rng = random.Random(seed)
    words = ["the", "The", "été", "日本", "x", "don't", "a1b", "\x00", "Zoë", *[f"w{chr(97 + i)}" for i in range(20)]]
    docs = [
        (" ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", "c\n", None, "hot", "hot"]))
        for _ in range(n)
    ]
    return docs + [(None, "en", "null only"), ("", "de", "x"), ("one two", "de", "y"), ("alone", "it", "z"), *docs[:20]]


def rows(spark, docs, **kwargs):
    frame = spark.createDataFrame([(i, *d, 5, "t") for i, d in enumerate(docs)], SCHEMA).repartition(5)
    found = divergence.audit(frame, **kwargs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("least,top,tile", [(10, 10, 32), (3, 4, 2), (1, 1000, 1)])
def test_against_the_definition(spark, least, top, tile):
    docs = documents(least)
    assert rows(spark, docs, least=least, top=top, tile=tile) == by_definition(docs, least, top)


def test_texts_cut_into_many_batches(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BATCH_BYTES", 50)
    docs = documents(9, 60) + [("word Other " * 3000, "en", "long")]
    assert rows(spark, docs, least=2) == by_definition(docs, 2, 10)


def test_blocks_of_a_few_rows(spark):
    docs = documents(10, 80)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert rows(spark, docs, least=1, tile=3) == by_definition(docs, 1, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    for total, terms in ((0, 1), (9, 4), (3_000_000_000_000, 50_000_000), (4_000_000_000_000_000, 7)):
        n = rng.integers(0, total + 1, 100)
        want = [1 + 10**9 * (int(x) + 2) // (total + 2 * terms) for x in n]
        assert divergence.shares(n, total, terms).tolist() == want


def test_shares_in_sql_are_exact(spark):
    data = [(0, 0, 1), (4_000_000_000_000_000, 4_000_000_000_000_000, 7), (7, 10, 3)]
    got = spark.createDataFrame(data, "a long, b long, c long").select(divergence.share("a", "b", "c").alias("p")).collect()
    assert sorted(r["p"] for r in got) == sorted(1 + 10**9 * (a + 2) // (b + 2 * c) for a, b, c in data)


def test_runs_of_columns_meet():
    rng = np.random.default_rng(2)
    for _ in range(200):
        weights = rng.integers(1, 4, rng.integers(1, 12))
        begin, width = np.cumsum(weights) - weights, int(weights.sum())
        columns, dense = [], []
        for _ in range(2):
            at = np.flatnonzero(rng.random(len(weights)) < 0.5)
            n = rng.integers(1, 3, len(at))
            starts, values = divergence.column_runs(at, n, begin)
            full = np.zeros(len(weights), np.int64)
            full[at] = n
            dense.append(divergence.shares(np.repeat(full, weights), 50, 6))
            columns.append((starts, divergence.shares(values, 50, 6)))
            assert (np.diff(values) != 0).all()
        p, q = dense
        assert divergence.met(*columns, width) == ((p - q) ** 2 // (p + q)).sum()


def test_query(spark, tmp_path):
    docs = documents(11)
    spark.createDataFrame([(i, *d, 5, "t") for i, d in enumerate(docs)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_divergence"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == by_definition(docs, 10, 10)
