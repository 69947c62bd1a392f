"""Runs against their definition, Lyndon arrays against theirs, and the whole query in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from palimpsest.llm import queries, runs


def lyndon_by_definition(x):
    """The distance to the next smaller suffix."""
    return [next((j - i for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x) - i) for i in range(len(x))]


def runs_by_definition(x, shortest, times):
    out = []
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, times * q):
                part = x[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(seed, n, longest, signs):
    rng = random.Random(seed)
    for _ in range(n):
        x = []
        while len(x) < rng.randrange(longest + 1):
            part = [rng.randrange(rng.choice(signs)) for _ in range(rng.randrange(1, 9))]
            x += part * rng.choice([1, 1, 2, 3, 5, 9])
        yield x[:longest]


def test_lyndon_arrays():
    for x in sequences(1, 1500, 40, [1, 2, 3, 9]):
        _, rank = np.unique(np.array(x, int), return_inverse=True)
        assert runs.lyndon(rank.tolist()) == lyndon_by_definition(x), x


@pytest.mark.parametrize("shortest,times", [(24, 3), (3, 3), (1, 4), (7, 3)])
def test_runs(shortest, times):
    for x in sequences(shortest, 400, 90, [1, 2, 3]):
        assert runs.runs_of(np.array(x, int), shortest, times) == runs_by_definition(x, shortest, times), x


def test_words_that_deceive_hashes():
    """The Thue-Morse sequence makes polynomial sums modulo powers of two meet; runs beside it must stay right."""
    t = [bin(i).count("1") % 2 for i in range(1 << 12)]
    other = [1 - v for v in t]
    x = np.array((t + other) * 1 + [5, 6, 7] * 12 + t + t + t + t)
    got = runs.runs_of(x)
    for start, length, q in got:
        part = x[start : start + length]
        assert (part[q:] == part[:-q]).all()
        assert start == 0 or x[start - 1] != x[start - 1 + q]
        assert start + length == len(x) or x[start + length] != x[start + length - q]
    assert (8192, 36, 3) in got and (8192 + 36, 4 * 4096, 4096) in got


def collapsed_by_definition(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, n=300):
    rng = random.Random(seed)
    blanks = [" ", "  ", "\n", "\t ", "\r\n", "\x0b"]
    made = []
    for x in sequences(seed, n, 80, [2, 3, 9]):
        lead = rng.choice(["", "", " ", "\n"])
        made.append(lead + "".join(["wörd", "a", "B", "日本", "x\xa0y", "f", "\x00", "　", "."][v] + rng.choice(blanks) for v in x))
    return [None, "", " ", "\n\t", "one", *made, *made[:20]]


def check(text, shortest, times, n, found, collapsed):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    want = runs_by_definition(words, shortest, times)
    assert n == len(words)
    assert [tuple(r) for r in found] == want
    assert collapsed == collapsed_by_definition(words, want)


def test_batches():
    some = texts(3)
    for column in (pa.array(some, pa.string()), pa.array([*["zz"] * 3, *some], pa.string()).slice(3)):
        counts, found, collapsed = runs.find(column, 6, 3)
        for k, text in enumerate(some):
            check(text, 6, 3, counts[k], found[k], collapsed[k].as_py())


def test_long_text_in_linear_time():
    x = np.array([i % 7 if 20_000 < i < 40_000 else i * i % 9973 for i in range(100_000)])
    for word in (x, np.zeros(100_000, int), np.array([i % 1000 for i in range(100_000)])):
        start = time.time()
        assert len(runs.runs_of(word)) >= 1
        assert time.time() - start < 10


def test_columns_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (1, "", 1), (None, "a b " * 15, 2), (None, "a b " * 15, 2)], "doc_id long, text string, runs int"
    )
    found = runs.find_runs(docs)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = [(r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()]
    assert sorted(got) == [(0, [], ""), (0, [], ""), (30, [(0, 30, 2)], "a b"), (30, [(0, 30, 2)], "a b")]
    assert runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs, times=2)


def test_query(spark, tmp_path):
    rng = random.Random(8)
    some = {i: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(300))) for i in range(300)}
    some |= {301: None, 302: "", 303: "w " * 40}
    spark.createDataFrame(list(some.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    with_runs = 0
    for r in queries.QUERIES["op12_runs"](spark, str(tmp_path)).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", some[r["doc_id"]] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = runs_by_definition(words, 24, 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in want)
        assert r["n_runs"] == len(want)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed_by_definition(words, want).encode()).hexdigest()
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        with_runs += bool(want)
    assert with_runs > 10
