"""The pipeline: its last rows against brute force over its own stages, and the entry without the subpackage."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from palimpsest.llm import decontam, jaccard, langid, pieces, toxicity
from palimpsest.llm.queries import PIECES
from test_decontam import brute as shared_windows
from test_jaccard import brute as similar

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables here")


def test_rows_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    told = {r["doc_id"] for r in langid.identify(docs, langid.fit(docs)).where("not lang_rejected").collect()}
    first = docs.where(docs.doc_id.isin(list(told)))
    clean = toxicity.score(first, toxicity.fit(first, labels)).where("toxic_pred = 0").select("doc_id", "text").collect()
    left = [tuple(r) for r in clean]
    left = [r for r, c in zip(sorted(left, key=lambda r: str(r[0])), similar(left)) if r[0] == c[2]]
    hit = {d for d, _, n, _ in shared_windows(left, items, 10) if n}
    left = dict(r for r in left if r[0] not in hit)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    assert set(got) == set(left) and 0 < len(left) < len(told) <= docs.count()
    model = pieces.load(PIECES)
    assert all(pieces.encode(model, [t])[0].tolist() == got[d]["pieces"] for d, t in left.items())


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "decontamination", "pieces"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), DATA).columns == docs.columns
        assert stage(spark, docs.limit(0), DATA).count() == 0


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} | {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert set(entry.oracle_sql()) <= names


def test_rows_do_not_decide_for_each_other(spark):
    """Null and repeated ids: every row is judged by its own text, and one row of each component stays."""
    item = " ".join(f"q{i}" for i in range(12))
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(20)) for w in "abcd")
    rows = [(None, item), (None, a), (None, a), (None, b), (1, b), (1, c), (1, item), (2, c + " more"), (2, d), (2, d), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = decontam.without(docs, decontam.decontaminate(docs, items))
    assert key(clean) == sorted((r for r in rows if r[1] != item), key=str)
    left = jaccard.representatives(clean, nulls_stay=False)
    assert key(left) == sorted([(None, a), (1, b), (1, c), (2, d), (None, None), (3, "")], key=str)
    stages = dict(corpus_pipeline.STAGES)
    assert key(stages["near_duplicates"](spark, clean, "")) == key(left)
