"""Pieces against the library's own encoder, for both kinds of model."""

from __future__ import annotations

import os
import random
import time

import pytest

from palimpsest.llm import pieces
from palimpsest.llm.queries import PIECES

sentencepiece = pytest.importorskip("sentencepiece")
pytestmark = pytest.mark.skipif(not os.path.isfile(PIECES), reason="no model here")


@pytest.fixture(scope="module")
def bpe():
    return pieces.load(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces and scores, read as a unigram model."""
    from sentencepiece import sentencepiece_model_pb2 as format_of

    proto = format_of.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pieces.UNIGRAM
    for p in proto.pieces:  # within what the library's single precision tells apart
        p.score = max(p.score, -100_000.0)
    path = str(tmp_path_factory.mktemp("model") / "unigram.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    return pieces.load(path), sentencepiece.SentencePieceProcessor(model_file=path)


def texts(seed):
    rng = random.Random(seed)
    signs = ["a", "b", " ", "  ", "é", "\n", "\t", "日本", "▁", "<0x41>", "\U0001f600", "the ", "ing", "THE", "</s>", "12", "’", "́", "don't"]
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(300)]
    return [None, "", " ", "    ", "x", " x ", "tokenization " * 20, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x7f", *made]


def test_bpe_is_the_librarys(bpe):
    model, own = bpe
    some = texts(1)
    got = pieces.encode(model, some)
    assert [g.tolist() for g in got] == [own.encode(t or "") for t in some]
    assert [pieces.decode(model, g) for g in got] == [own.decode(own.encode(t or "")) for t in some]


def test_unigram_is_the_librarys(unigram):
    model, own = unigram
    some = [t for t in texts(2) if t]
    got = pieces.encode(model, some)
    for text, ids in zip(some, got):
        want = own.encode(text)
        # Ties between paths may be broken either way; the value of the path may not differ.
        if ids.tolist() != want:
            assert sum(model.scores[ids]) == pytest.approx(sum(model.scores[want]), abs=0.5)
            assert pieces.decode(model, ids) == own.decode(want)


def test_small_caches_and_batches_change_nothing(bpe, monkeypatch):
    some = texts(3)
    want = [g.tolist() for g in pieces.encode(bpe[0], some)]
    for name, value in (("CACHED_BYTES", 3), ("CACHED_PAIRS_LOG2", 2), ("CELLS", 1), ("TOGETHER", 3)):
        monkeypatch.setattr(pieces, name, value)
    assert [g.tolist() for g in pieces.encode(pieces.load(PIECES), some)] == want


def test_a_full_cache_is_not_kept(monkeypatch):
    """What stays between batches, and while a worker waits, is within its limit."""
    model = pieces.load(PIECES)
    words = [f"word{i}" for i in range(2000)]
    pieces.encode(model, [" ".join(words[:100])])
    assert len(model.words) >= 100  # few words stay
    monkeypatch.setattr(pieces, "CACHED_BYTES", 100_000)
    want = pieces.encode(pieces.load(PIECES), words)
    got = pieces.encode(model, words)
    assert [x.tolist() for x in got] == [x.tolist() for x in want]
    assert model.cached == 0 and not model.words


def test_long_words(bpe, unigram):
    """Words without a space in many stretches, and very long ones in seconds."""
    rng = random.Random(6)
    for signs in ("abcdefghijklmnop0123456789+/", "日本語文字列中国人", "a", "ab", "\U0001f600é"):
        for n in (576, 577, 2000):
            text = "".join(rng.choice(signs) for _ in range(n))
            (got,) = pieces.encode(bpe[0], [text])
            assert got.tolist() == bpe[1].encode(text)
    text = "".join(rng.choice("的一是不了人我在有他这中大来上国 abcXYZ09"[rng.randrange(2) :]) for _ in range(400))
    (got,) = pieces.encode(unigram[0], [text])
    assert pieces.decode(unigram[0], got) == text
    text = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(200_000))
    start = time.time()
    (got,) = pieces.encode(bpe[0], [text])
    assert time.time() - start < 15
    assert pieces.decode(bpe[0], got) == text
    start = time.time()
    assert pieces.decode(bpe[0], pieces.encode(bpe[0], ["a" * 200_000])[0]) == "a" * 200_000
    assert time.time() - start < 15


@pytest.mark.parametrize("stretch,overlap", [(7, 3), (5, 1), (16, 15)])
def test_stretches_of_any_size(bpe, monkeypatch, stretch, overlap):
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    monkeypatch.setattr(pieces, "OVERLAP", overlap)
    rng = random.Random(stretch)
    for _ in range(60):
        text = "".join(rng.choice(["tion", "the", "a", "b", "é", "日", "x", "ing"]) for _ in range(rng.randrange(1, 60)))
        bpe[0].words.clear()
        assert pieces.encode(bpe[0], [text])[0].tolist() == bpe[1].encode(text)


def test_decoding_together_is_decoding_alone(bpe, unigram):
    import numpy as np

    for model, own in (bpe, unigram):
        lists = [np.array(own.encode(t or ""), np.int64) for t in texts(7)] + [np.array([0, 5, 300]), np.array([13, 300]), np.array([1, 2])]
        together = pieces.decode_all(model, np.concatenate(lists).astype(np.int64), np.array([len(x) for x in lists]))
        assert together == [pieces.decode(model, x) for x in lists]


def test_columns(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts(4))] + [(1, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pieces int")
    encoded = pieces.encode_column(docs, PIECES)
    assert encoded.columns == ["doc_id", "text", "pieces", "n_pieces"]
    decoded = pieces.decode_column(encoded, PIECES, out="back").withColumn("same", pieces.round_trips(decoded="back"))
    for r in decoded.collect():
        assert r["same"] and r["n_pieces"] == len(r["pieces"] or [])
        assert (r["pieces"] is None) == (r["text"] is None) == (r["back"] is None)
    once = pieces.encode_column(docs, PIECES, decoded="back").withColumn("same", pieces.round_trips(decoded="back"))
    assert sorted(map(str, once.collect())) == sorted(map(str, decoded.select(once.columns).collect()))
    assert pieces.encode_column(docs.limit(0), PIECES).count() == 0
