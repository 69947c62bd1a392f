"""The language model: its probabilities, gradients, averages and scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from palimpsest.llm import lm
from palimpsest.llm import words as W


@pytest.fixture(scope="module")
def corpus(spark):
    """Sentences of a small grammar: every word follows from the one before."""
    rng = random.Random(1)
    after = {w: rng.sample([f"w{i}" for i in range(40)], 2) for w in [f"w{i}" for i in range(40)]}

    def text(n):
        w = rng.choice(list(after))
        out = [w]
        for _ in range(n):
            w = rng.choice(after[w])
            out.append(w)
        return out

    known = [(i, " ".join(text(300))) for i in range(400)]
    fresh = [text(60) for _ in range(20)]
    return known, fresh


def test_probabilities_add_up_to_one():
    net = lm.Network.new(3)
    around = np.array([[lm.OUTSIDE, 1, 2, 3, 4, 4095]])
    every = np.arange(lm.VOCABULARY)
    each = lm.log_probabilities(net, net.reach(), np.repeat(around, len(every), 0), every)
    assert math.isclose(np.exp(each).sum(), 1.0, rel_tol=1e-4)


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    net = lm.Network.new(5)
    around, target = rng.integers(0, lm.VOCABULARY + 1, (7, 2 * lm.SIDE)), rng.integers(0, lm.VOCABULARY, 7)
    wide = lm.Network(*[getattr(net, f).astype(np.float64) for f in ("words", "inner", "shift", "classes", "within")])
    loss = lambda: -lm.log_probabilities(wide, wide.reach(), around, target).mean()
    grads = lm._gradient(wide, around, target)
    for name, grad in zip(("words", "inner", "shift", "classes", "within"), grads):
        value = getattr(wide, name)
        for at in [np.unravel_index(np.abs(grad).argmax(), grad.shape), tuple(0 for _ in grad.shape)]:
            before = value[at]
            value[at] = before + 1e-4
            high = loss()
            value[at] = before - 1e-4
            slope = (high - loss()) / 2e-4
            value[at] = before
            assert math.isclose(slope, grad[at], rel_tol=1e-2, abs_tol=1e-5), name


def test_windows_stay_within_a_text():
    w = W.split(pa.array(["a b", None, "c"]), W.ALNUM)
    got = lm._windows(np.array([10, 11, 12]), w.first, np.arange(3))
    out = lm.OUTSIDE
    assert got.tolist() == [[out, out, out, 11, out, out], [out, out, 10, out, out, out], [out] * 6]


def test_flat_and_back():
    net = lm.Network.new(9)
    again = lm.Network.unflat(net.flat())
    assert all(np.array_equal(getattr(net, f), getattr(again, f)) for f in ("words", "inner", "shift", "classes", "within"))


def test_average_is_weighted_at_any_width(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 2)
    rows = [(c, b, c + 1, np.full(3, c * 10 + b, np.float32).tobytes()) for c in range(5) for b in range(2)]
    df = spark.createDataFrame(rows, "copy long, block int, rows long, data binary")
    want = [sum((c + 1) * (c * 10 + b) for c in range(5)) / 15 for b in range(2) for _ in range(3)]
    assert np.allclose(lm._average(df), want)


def test_grammar_is_learned(spark, corpus):
    known, fresh = corpus
    docs = spark.createDataFrame(known, "doc_id long, text string").repartition(3)
    model = lm.fit(docs, rate=2, rounds=4)
    rng = random.Random(2)
    mixed = [rng.sample(t, len(t)) for t in fresh]
    rows = [(i, " ".join(t)) for i, t in enumerate([*fresh, *mixed])]
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model, rows=50).collect()}
    good = sum(got[i]["log_prob"] for i in range(20)) / (20 * 61)
    bad = sum(got[i]["log_prob"] for i in range(20, 40)) / (20 * 61)
    assert good > -math.log(40) + 1.0  # far better than by frequency
    assert good > bad + 1.0
    # Brute force: every word by itself.
    w = W.split(pa.array([rows[0][1]]), W.ALNUM)
    ids = lm._ids(w.hashes, model.hashes, model.ids)
    reach = model.network.reach()
    each = [lm.log_probabilities(model.network, reach, lm._windows(ids, w.first, np.array([k])), ids[[k]])[0] for k in range(61)]
    assert math.isclose(sum(each), got[0]["log_prob"], rel_tol=1e-5)


def test_nulls_empty_and_repeats(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b a", "x"), (3, "a b a", "x"), (None, "!", "x")], "doc_id long, text string, n_words string")
    model = lm.fit(docs, rate=1, rounds=1)
    got = lm.score(docs, model)
    assert got.columns == ["doc_id", "text", "n_words", "log_prob", "perplexity"]
    rows = {(r["doc_id"], r["n_words"], round(r["log_prob"], 6), r["perplexity"] is None) for r in got.collect()}
    assert {r[1:] for r in rows if r[0] != 3} == {(0, 0.0, True)}
    assert len([r for r in rows if r[0] == 3]) == 1 and all(r[2] < 0 for r in rows if r[0] == 3)
    empty = docs.limit(0)
    assert lm.score(empty, lm.fit(empty)).count() == 0


def test_production_rounds_train_on_every_word(spark, monkeypatch):
    """With the module's own parameters the rows trained on are all words, those of short texts too."""
    docs = spark.createDataFrame([(i, " ".join(f"t{i}x{k}" for k in range(1 + i % 9))) for i in range(90)], "doc_id long, text string")
    seen = []
    average = lm._average

    def counted(copies):
        once = copies.where("block = 0").agg({"rows": "sum"}).first()[0]
        seen.append(once)
        return average(copies)

    monkeypatch.setattr(lm, "_average", counted)
    lm.fit(docs)
    assert sum(seen) == sum(1 + i % 9 for i in range(90)) and len(seen) == lm.ROUNDS


def test_words_outside_have_probabilities_of_their_own(spark, monkeypatch):
    """Words of one bucket are told apart by their counts, unseen ones get the least, and a bucket adds up to one."""
    monkeypatch.setattr(lm, "NAMED", 4)
    counts = {f"w{i}": 1 + i % 7 for i in range(300)}
    docs = spark.createDataFrame([(i, " ".join([w] * n + ["a b c d"] * 9)) for i, (w, n) in enumerate(counts.items())], "doc_id long, text string")
    model = lm.fit(docs)
    asked = [*counts, "never", "seen", "w1 w1 w6", "w1 w1 w6", "a b"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score(rows, model).collect()}
    monkeypatch.undo()  # tasks have the module as it is
    # The network's part, and the shares by hand.
    bucket = {w: int(W.split(pa.array([w]), W.ALNUM).hashes[0] & np.uint64(63)) for w in [*counts, "never", "seen"]}
    of = {b: [counts[w] for w in counts if bucket[w] == b] for b in range(64)}
    reach = model.network.reach()
    for i, t in enumerate(asked):
        w = W.split(pa.array([t]), W.ALNUM)
        ids = lm._ids(w.hashes, model.hashes, model.ids)
        net = lm.log_probabilities(model.network, reach, lm._windows(ids, w.first, np.arange(len(ids))), ids).sum()
        share = sum(math.log((counts.get(x, 0) + 1) / (1 + len(of[bucket[x]]) + sum(of[bucket[x]]))) for x in t.split() if x in bucket)
        assert math.isclose(got[i]["log_prob"], net + share, rel_tol=1e-5), t
        assert math.isclose(got[i]["perplexity"], math.exp(-(net + share) / len(ids)), rel_tol=1e-4)
    for b, ns in of.items():
        assert math.isclose(sum(n + 1 for n in ns) + 1, model.totals[b])


def test_numbers_are_cut_by_words(monkeypatch):
    """Parts of a batch hold about HELD words, or one longer text; together they are the batch."""
    monkeypatch.setattr(lm, "HELD", 4)
    texts = [[1, 2], [3], [], [4, 5, 6, 7, 8, 9], [], [4095]]
    ids = pa.array([np.array(t, "<u2").tobytes() for t in texts], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), ids], names=["key", "ids"])
    for whole in (batch, batch.slice(1), batch.slice(6)):
        got = []
        for part, number, first in lm._numbers(iter([whole])):
            assert len(number) <= 4 or part.num_rows == 1
            got += [(k, number[a:b].tolist()) for k, a, b in zip(part.column("key").to_pylist(), first, first[1:])]
        assert got == [(k, texts[k]) for k in whole.column("key").to_pylist()]


def test_fit_and_score_is_fit_then_score(spark):
    """Also with columns that have the names used inside, and with a text longer than a slice."""
    rng = random.Random(4)
    long = " ".join(f"v{int(rng.expovariate(0.002))}" for _ in range(450_000))
    assert len(long) > W.BATCH_BYTES
    rows = [(1, "a b c a", 5, None), (2, long, 6, "k"), (3, None, 7, "s"), (None, "a b c a", 8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, key string").coalesce(1)
    docs = docs.withColumn("ids", docs.row).withColumn("share", docs.key).withColumn("log_prob", docs.row)
    model = lm.fit(docs)
    want = {r["row"]: r for r in lm.score(docs, model).collect()}
    got = lm.fit_and_score(docs, ["doc_id", "row", "key", "ids", "share", "log_prob"])
    assert got.columns == ["doc_id", "row", "key", "ids", "share", "n_words", "log_prob", "perplexity"]
    for r in got.collect():
        assert all(r[n] == want[r["row"]][n] for n in ("doc_id", "key", "ids", "share", "n_words"))
        assert math.isclose(r["log_prob"], want[r["row"]]["log_prob"], rel_tol=1e-6, abs_tol=1e-9)
    assert want[6]["n_words"] == 450_000 and want[7]["n_words"] == 0
    # The long text by itself, a few words at a time.
    w = W.split(pa.array([long]), W.ALNUM)
    number = lm._ids(w.hashes, model.hashes, model.ids)
    reach = model.network.reach()
    net = sum(
        lm.log_probabilities(model.network, reach, lm._windows(number, w.first, some), number[some]).sum()
        for some in np.array_split(np.arange(len(number)), 90)
    )
    word, times = np.unique(w.hashes[number >= lm.NAMED], return_counts=True)
    share = sum(n * math.log((n + 1) / model.totals[int(h & np.uint64(63))]) for h, n in zip(word, times))
    assert math.isclose(want[6]["log_prob"], net + share, rel_tol=1e-5)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    """Trained once on four fifths of the documents: perplexity of the rest against a unigram model of the same words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = lm.fit(docs.where("doc_id % 5 != 0"))
    rest = docs.where("doc_id % 5 = 0")
    scored = lm.score(rest, model).toPandas()
    known = {r["word"]: r["n"] for r in model.counts.collect()}
    total = sum(known.values()) + len(known) + 1
    unigram = sum(r["n"] * math.log((known.get(r["word"], 0) + 1) / total) for r in lm._counts(rest).collect())
    words = scored["n_words"].sum()
    assert math.exp(-scored["log_prob"].sum() / words) < 0.75 * math.exp(-unigram / words)
