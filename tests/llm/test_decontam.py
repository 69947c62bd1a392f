"""Decontamination against windows in plain Python."""

from __future__ import annotations

import random

import pytest

from palimpsest.llm.decontam import decontaminate, without
from test_words import ALNUM, plain


def brute(docs, items, span):
    windows = {}
    for item, text in items:
        w = plain(text, ALNUM)
        n = min(span, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = plain(text, ALNUM)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[g]
        out.append((doc, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*x, "n", 1) for x in docs], "doc_id long, text string, n_words string, hash int")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate(d, b, **kw).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows], key=str)


def test_many_random_texts(spark):
    rng = random.Random(3)
    words = [f"W{i}" for i in range(6)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    docs = []
    for i in range(60):
        parts = [rng.choice(words) + str(rng.randrange(50)) for _ in range(rng.randrange(20))]
        for _ in range(rng.randrange(3)):
            w = rng.choice(items)[1].split()
            at = rng.randrange(len(w))
            parts += w[at : at + rng.randrange(1, 26)]
        docs.append((i, ", ".join(parts)))
    assert run(spark, docs, items) == brute(docs, items, 10)


def test_nulls_empty_repeats_and_ties(spark):
    long = "a a a a a a a a a a a a"
    docs = [(1, None), (2, ""), (3, "!?"), (4, long), (4, long), (4, "b c"), (None, "x B, c"), (5, "a " * 9)]
    items = [(1, long), (2, long), (None, "b c"), (3, None), (4, ""), (None, None)]
    assert run(spark, docs, items) == brute(docs, items, 10)
    assert run(spark, docs, []) == [(d, n, 0, []) for d, n, _, _ in brute(docs, items, 10)]
    assert run(spark, [], items) == []


@pytest.mark.parametrize("k, span", [(1, 1), (3, 3), (2, 7)])
def test_other_lengths(spark, k, span):
    rng = random.Random(span)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(30))) for i in range(8)]
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12)))) for i in range(6)]
    assert run(spark, docs, items, k=k, span=span) == brute(docs, items, span)


def test_without(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {item}"), (2, "x y"), (None, None)], "doc_id long, text string")
    found = decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r["doc_id"] for r in without(docs, found).collect()} == {2, None}
    with pytest.raises(ValueError):
        decontaminate(docs, docs, k=11)
