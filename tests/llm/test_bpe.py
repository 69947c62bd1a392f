"""Byte-level BPE against the public library, and the scan against its own definition."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from palimpsest.llm import bpe, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
regex = pytest.importorskip("regex")

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.of, special_tokens={})


def texts(seed, n=600):
    rng = random.Random(seed)
    signs = [
        "a", "b", " ", "  ", "   ", "é", "\n", "\t", "\r\n", "日本", "　", "\xa0", " ", "\U0001f600", "the ", "ing", "'", "'s", "'re",
        "'ve", "'ll", "'l", "'t", "'S", "''", "s", "re", "12", "½", "٣", "’", "́", "don't", "!", "?!", "_", "<|endoftext|>", "\x00", "‍", "Ⅷ",
    ]
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(n)]
    return ["", " ", "  ", "\n", " \n ", "'", "'s", " 's", "a's", "1's's", "'sa", "'rea", "'r", "x' s", *made]


def split(text):
    data, offsets = W_buffers([text])
    at = [*bpe.borders(data, offsets).tolist(), len(data)]
    return [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])]


def W_buffers(some):
    from palimpsest.llm import words

    return words.buffers(pa.array(some, pa.string()))


def test_slices_are_the_patterns():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in texts(1):
        assert split(text) == pattern.findall(text), repr(text)


def test_slices_do_not_cross_texts():
    some = texts(2)
    data, offsets = W_buffers(some)
    got = bpe.borders(data, offsets).tolist()
    want = []
    for text, at in zip(some, offsets.tolist()):
        for piece in split(text):
            want.append(at)
            at += len(piece.encode())
    assert got == want


@pytest.mark.parametrize("rows", [2, 3, 16])
def test_scan_is_associative(rows):
    table, _, of_symbol, _ = bpe._monoid()
    assert len(table) < 60
    x = of_symbol[np.random.default_rng(3).integers(0, 16, 1000)]
    want, total = [], 0
    for f in x:
        total = table[total, f]
        want.append(total)
    assert bpe.scan(x, rows).tolist() == want


def test_ids_are_the_librarys(ranks, library):
    some = [*texts(4), None]
    ids, ends, counts = bpe.encode(ranks, pa.array(some, pa.string()))
    at = 0
    for text, n in zip(some, counts):
        mine, placed = ids[at : at + n], ends[at : at + n]
        at += n
        assert mine.tolist() == library.encode_ordinary(text or ""), repr(text)
        assert bpe.decode(ranks, mine, placed) == bpe.decode(ranks, mine) == (text or "").encode()
        # The ends cut the bytes where tokens meet.
        first = 0
        for token, end in zip(mine.tolist(), placed.tolist()):
            assert (text or "").encode()[first:end] == library.decode_single_token_bytes(token)
            first = end


def test_every_code_point_after_a_letter_and_before_one(ranks, library):
    """Classes agree with the library for all code points up to its own version of Unicode."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and bpe.unicodedata.category(chr(c)) != "Cn"]
    differ = 0
    for at in range(0, len(points), 20_000):
        some = [f"a{chr(c)}b {chr(c)}1" for c in points[at : at + 20_000]]
        ids, _, counts = bpe.encode(ranks, pa.array(some))
        want = library.encode_ordinary_batch(some, num_threads=4)
        ends = np.cumsum(counts)
        differ += sum(ids[e - n : e].tolist() != w for e, n, w in zip(ends, counts, want))
    assert differ == 0


def test_long_slices_take_little_time(ranks, library):
    rng = random.Random(5)
    for signs in ("abcdefgh", "日本語文字"):
        text = "".join(rng.choice(signs) for _ in range(300_000))
        start = time.time()
        ids, _, _ = bpe.encode(ranks, pa.array([text]))
        assert time.time() - start < 20
        assert bpe.decode(ranks, ids) == text.encode()
    short = text[:3000]
    assert bpe.encode(ranks, pa.array([short]))[0].tolist() == library.encode_ordinary(short)


def test_slices_side_by_side_and_alone(ranks):
    rng = random.Random(9)
    for n in (1, 2, 3, 7, 20):
        some = ["".join(rng.choice(["the", "a", "b", "ing", "é", " ", "!", "z"]) for _ in range(n)).encode()[: max(1, n)] for _ in range(200)]
        for size in {len(x) for x in some}:
            own = [x for x in some if len(x) == size]
            want = [np.array(ranks.merge(x), np.uint32).tobytes() for x in own]
            if size > 1:
                assert ranks.merge_all(own) == want
            assert ranks.ids(own) == want


def test_small_caches_and_batches_change_nothing(spark, monkeypatch):
    some = texts(6, 100) + ["word " * 5000]
    want = [bytes(r[0]) for r in bpe.encode_column(frame(spark, some), PATH).select("tokens").collect()]
    small = bpe.Ranks(PATH)
    monkeypatch.setattr(bpe, "CACHED_BYTES", 500)
    monkeypatch.setattr(bpe, "SIDE_BY_SIDE", 5)
    ids, _, counts = bpe.encode(small, pa.array(some))
    cuts = np.cumsum(counts)[:-1]
    assert [x.tobytes() for x in np.split(ids, cuts)] == want


def frame(spark, some):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(some)], "doc_id long, text string, tokens string")


def test_columns_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (1, "", 1), (None, "it's", 2), (None, "it's", 2)], "doc_id long, text string, n_tokens int"
    )
    got = bpe.decode_column(bpe.encode_column(docs, PATH), PATH)
    assert got.columns == ["doc_id", "text", "tokens", "token_ends", "n_tokens", "decoded"]
    found = sorted([(r["n_tokens"], r["decoded"] and bytes(r["decoded"]), r["tokens"] is None) for r in got.collect()], key=str)
    assert found == sorted([(0, None, True), (0, bytearray(), False), (2, b"it's", False), (2, b"it's", False)], key=str)
    assert bpe.encode_column(docs.limit(0), PATH).count() == 0
    lone = bpe.decode_column(bpe.encode_column(docs, PATH).drop("token_ends"), PATH, ends=None)
    assert lone.where("decoded is null").count() == 1


def test_query(spark, library, tmp_path):
    some = [*texts(7, 50), None]
    spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.QUERIES["op13_bpe"](spark, str(tmp_path)).collect():
        text = some[r["doc_id"]] or ""
        want = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert r["n_tokens"] == len(want) // 4
        assert r["ids_sha256"] == hashlib.sha256(want).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
