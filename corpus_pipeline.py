"""A corpus pipeline: five operators, each on what the one before has kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import decontam, jaccard, langid, pieces, toxicity
from palimpsest.llm.queries import PIECES
from palimpsest.llm.shared import table
from palimpsest.session import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin, learned from the given languages."""
    found = langid.identify(docs, langid.fit(docs))
    return found.where(~F.col("lang_rejected")).select(docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, learned from the labelled ones."""
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("toxic_pred") == 0).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id; null ids come last and stand for no other."""
    return jaccard.representatives(docs, nulls_stay=False)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontam.without(docs, decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as ids of pieces."""
    return pieces.encode_column(docs, PIECES).select("doc_id", "lang", "source", "n_pieces", "pieces")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("pieces", encoded),
]

# Compression, training, and pieces have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = f"{shared_dir(spark)}/palimpsest/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
