"""Components of similar documents against all pairs, and components of graphs against a search."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from palimpsest.llm import graph, jaccard
from palimpsest.llm.graph import components
from test_words import SPACED, plain


def brute(docs):
    sets = []
    for _, text in docs:
        w = plain(text, SPACED)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    lead = list(range(len(docs)))

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                lead[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [d for k, (d, _) in enumerate(docs) if find(k) == find(i) and d is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def run(spark, docs):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, c string")
    return sorted([tuple(r) for r in jaccard.near_duplicates(df).collect()], key=str)


def corpus(seed, n):
    """Copies with few and many words changed, chains of them, shared passages."""
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(40)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.6:
            w = (docs[rng.randrange(len(docs))][1] or "x").split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1, 2])] = [f"c{rng.randrange(10**6)}"]
        else:
            w = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 4, 5, 6, 30, 90]))]
            if kind > 0.8:
                w = w + shared
        docs.append((n - i, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpora(spark, seed):
    docs = corpus(seed, 120)
    assert run(spark, docs) == brute(docs)


def test_frequent_shingles_come_last_and_change_nothing(spark, monkeypatch):
    docs = corpus(5, 80)
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "SKETCH", 1)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "COMPARED", 64)
    assert run(spark, docs) == brute(docs)


def test_nulls_empty_and_repeats(spark):
    docs = [(3, None), (4, ""), (5, " \n"), (7, "a b"), (6, "A\tb"), (6, "A\tb"), (None, "a b"), (8, "b a"), (None, "z")]
    docs += [(9, None), (2, "one two three four five six"), (1, "one two three four five")]
    assert run(spark, docs) == brute(docs)
    assert run(spark, []) == []


def test_links_of_a_round_are_not_sought_again(spark, monkeypatch):
    """One group of near copies is one component after the first round, and the later ones have nothing left to join."""
    steps = []

    def counted(df, *done, cut=graph.cut):
        steps.append(df)
        return cut(df, *done)

    monkeypatch.setattr(jaccard, "cut", counted)
    monkeypatch.setattr(graph, "cut", counted)
    text = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*text[:i], "x", *text[i + 1 :]])) for i in range(8)]
    assert run(spark, docs) == brute(docs)
    assert len(steps) <= 14
    del steps[:]
    got = graph.components(spark.createDataFrame([(0, i) for i in range(1, 9)], "a long, b long"))
    assert got.count() == 9 and len(steps) == 1


def test_representatives(spark):
    docs = [(2, "a b"), (1, "a b"), (1, "a b"), (3, None), (None, "a b"), (5, "c")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, _kept string")
    kept = jaccard.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 1, 3, 5]


def test_signatures_bound_the_overlap():
    import numpy as np

    rng = np.random.default_rng(1)
    for a, b in [(3, 3), (10, 700), (64, 65), (5000, 5100)]:
        pool = rng.integers(0, 1 << 62, a + b)
        x, y = np.unique(pool[:a]), np.unique(pool[a // 2 : a // 2 + b])
        column = pa.array([jaccard._signature(x), jaccard._signature(y)], pa.binary())
        (apart,) = jaccard._apart(column, np.array([0]), np.array([1]))
        assert 0 < apart <= len(np.setxor1d(x, y))
        assert jaccard._apart(column, np.array([1]), np.array([0]), column).tolist() == [apart]


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 8)], [(0, i) for i in range(1, 50)] + [(60, 59)]])
def test_components(spark, edges):
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    for n in sorted(nodes):
        if n not in want:
            todo = [n]
            while todo:
                k = todo.pop()
                if k not in want:
                    want[k] = n
                    todo += [b if a == k else a for a, b in edges if k in (a, b)]
    assert got == want
