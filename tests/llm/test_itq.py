"""Near-duplicate embeddings against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from palimpsest.llm import itq


def brute(rows, cosine=0.9):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = {i: set() for i in range(len(rows))}
    for i, (_, v) in enumerate(rows):
        for j, (_, u) in enumerate(rows[:i]):
            if good(v) and good(u) and len(u) == len(v):
                a, b = np.array(v, np.float64), np.array(u, np.float64)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[i].add(j), links[j].add(i)
    out = []
    for i, (vec, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec, len(links[i]), low, vec == low))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, c int")
    return sorted([tuple(r) for r in itq.near_duplicates(df, **kw).collect()], key=str)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (4, [2.0, 0.0]), (4, [2.0, 0.0]), (3, [1.0, 0.0]), (9, [0.0, 1.0]), (8, None), (7, []), (6, [0.0, 0.0]),
            (1, [nan, 1.0]), (2, [inf, 1.0]), (10, [None, 1.0]), (None, [0.0, 3.0]), (11, [1.0, 0.0, 0.0]), (12, [-1.0, 0.0]), (13, [5.0])]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert run(spark, []) == []


def cloud(seed, n, d, near):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    extra = []
    for cosine in near:
        base = x[rng.integers(0, n, 60)]
        unit = base / np.linalg.norm(base, axis=1, keepdims=True)
        other = rng.standard_normal(base.shape)
        other -= (other * unit).sum(1, keepdims=True) * unit
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        extra.append(cosine * unit + math.sqrt(1 - cosine**2) * other)
    x = np.concatenate([x, *extra])
    return [(i, [float(f) for f in np.float32(v)]) for i, v in enumerate(x)]


@pytest.mark.parametrize("d", [16, 64, 100])
def test_recall_and_precision(spark, d):
    rows = cloud(d, 900, d, [0.905, 0.93, 0.98])
    got = {r[0]: r for r in run(spark, rows)}
    want = {r[0]: r for r in brute(rows)}
    found, all_of_them = sum(r[1] for r in got.values()), sum(r[1] for r in want.values())
    assert all(got[i][1] <= want[i][1] for i in want)  # no link below the threshold
    assert found >= 0.95 * all_of_them


def around_a_mean(seed, n, mean, near):
    """Unit vectors of 64 dimensions of the mean cosine, and partners for the first of them at a cosine of 0.905."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = math.sqrt(mean) * np.eye(64)[0] + math.sqrt(1 - mean) * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.standard_normal((near, 64))
    aside -= (aside * x[:near]).sum(1, keepdims=True) * x[:near]
    return x, 0.905 * x[:near] + math.sqrt(1 - 0.905**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)


@pytest.mark.parametrize("width, mean", [(20, 0.0), (25, 0.0), (20, 0.3), (16, 0.6)])
def test_tables_follow_the_width_and_the_mean(width, mean):
    x, y = around_a_mean(1, 4000, mean, 2000)
    models, narrow, apart = itq._fitted({64: x}, 0.9, width)
    centre, axes = models[64]
    fx, fy = (x[:2000] - centre) @ axes, (y - centre) @ axes
    (bx, wx), (by, wy) = itq._chunks(fx, narrow), itq._chunks(fy, narrow)
    differ = bx != by
    met = [np.take_along_axis(differ, w, 2).sum(2) == differ.sum(2) for w in (wx, wy)]
    assert (met[0] | met[1]).any(1).mean() >= 0.9
    assert (((fx >= 0) != (fy >= 0)).mean(1) <= apart).mean() > 0.99


def test_recall_in_wide_chunks_around_a_mean(spark):
    rows = [(i, [float(f) for f in np.float32(v)]) for i, v in enumerate(np.concatenate(around_a_mean(2, 700, 0.3, 300)))]
    got, want = {r[0]: r for r in run(spark, rows, width=22)}, {r[0]: r for r in brute(rows)}
    assert all(got[i][1] <= want[i][1] for i in want)
    assert sum(r[1] for r in got.values()) >= 0.9 * sum(r[1] for r in want.values()) >= 500


def test_threshold_is_checked(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, [1.0])], cosine=0.0)
