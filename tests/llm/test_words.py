"""Words and their hashes in numpy against plain Python."""

from __future__ import annotations

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import words as W

ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

texts = st.lists(st.none() | st.text("aB9 é.\n\t日", max_size=30), max_size=6)


def plain(text, pattern):
    return pattern.findall((text or "").translate(ASCII))


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(some):
    for table, pattern in ((W.ALNUM, ALNUM), (W.SPACED, SPACED)):
        w = W.split(pa.array(some, pa.string()), table)
        want = [plain(t, pattern) for t in some]
        assert w.counts.tolist() == [len(x) for x in want]
        flat = [x for one in want for x in one]
        hashes = w.hashes.tolist()
        # Equal words have equal hashes, different ones different hashes.
        assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_words_over_chunks(monkeypatch):
    text = "ab " * 40 + "x" * 333 + " ab " + "x" * 333 + " " + "x" * 332
    whole = W.split(pa.array([text]), W.ALNUM).hashes.tolist()
    monkeypatch.setattr(W, "CHUNK", 64)
    cut = W.split(pa.array([text]), W.ALNUM).hashes.tolist()
    assert cut[:40] == whole[:40] and cut[0] == cut[41]
    assert cut[40] == cut[42] != cut[43]  # words longer than a chunk


def test_slices_of_a_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 50, "c"]})
    parts = list(W.slices(iter([batch, batch.slice(0, 0), batch.slice(3)]), "text", most=20))
    assert [p.column("text").to_pylist() for p in parts] == [["a" * 10, None, ""], ["b" * 50], ["c"], ["b" * 50], ["c"]]


def test_ngrams_stay_within_a_text():
    w = W.split(pa.array(["a b c", "b c", "a"]), W.ALNUM)
    ok = W.within(w.owner, 2)
    two = W.ngrams(w.hashes, 2)
    assert ok.tolist() == [True, True, False, True, False]
    assert two[1] == two[3] != two[0]
