"""Benchmark decontamination by winnowing.

Of every `span - k + 1` consecutive k-grams of words the one with the smallest hash (the last of
equals) is a fingerprint. Any `span` equal words in a document and an item hold the same
fingerprint at the same place, so joining fingerprints finds every shared span; each match is
then extended word by word over the neighbours it carries, and counts from `span` words on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W
from palimpsest.llm.shared import bitmap, cut, in_bitmap

K = 5
SPAN = 10
# The bitmap of item fingerprints that documents are tested against has 2**26 bits: 8 MB.
BITMAP_LOG2 = 26

# Fingerprints of one text: hash, the place of its first word, and the words around it
# (none for whole short items).
_PRINT = T.StructType(
    [
        T.StructField("hash", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("around", T.ArrayType(T.LongType())),
    ]
)
_PRINT_ARROW = pa.struct(
    [("hash", pa.int64()), ("pos", pa.int32()), ("around", pa.list_(pa.int64()))]
)


def _chosen(grams: np.ndarray, owner: np.ndarray, k: int, span: int) -> np.ndarray:
    """Places of the fingerprints: the last smallest k-gram of every window of span words."""
    width = span - k + 1
    whole = W.within(owner, span)
    n = len(whole)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for d in range(1, width):
        other = grams[d : d + n]
        better = other <= best
        np.copyto(best, other, where=better)
        at[better] = d
    mark = np.zeros(len(grams), bool)
    mark[(np.arange(n) + at)[whole]] = True
    return np.flatnonzero(mark)


def _around(w: W.Words, owner: np.ndarray, at: np.ndarray, k: int, span: int, edge: int) -> np.ndarray:
    """The words from span - k before to span - k behind each k-gram; `edge` stands outside the text."""
    place = at[:, None] + np.arange(k - span, span)[None, :]
    inside = (place >= 0) & (place < len(w.hashes))
    place = np.clip(place, 0, max(0, len(w.hashes) - 1))
    inside &= owner[place] == owner[at][:, None]
    return np.where(inside, w.hashes[place].view(np.int64), np.int64(edge))


def _prints(w: W.Words, k: int, span: int, short: list[int], edge: int, items: bool, bits=None):
    """(text, hash, pos, around as rows or None) of the fingerprints, as numpy arrays."""
    owner = w.owner
    out = []
    grams = W.ngrams(w.hashes, k)
    if len(w.hashes) >= span:
        at = _chosen(grams, owner, k, span)
        if bits is not None:
            at = at[in_bitmap(bits, grams[at])]
        out.append((owner[at], grams[at], at, _around(w, owner, at, k, span, edge)))
    for n in short:  # items of fewer words are looked for whole
        if len(w.hashes) < n:
            continue
        whole = W.mix(W.ngrams(w.hashes, n) ^ np.uint64(n))
        ok = W.within(owner, n)
        if items:
            ok = ok & (w.counts[owner[: len(ok)]] == n)
        at = np.flatnonzero(ok)
        if bits is not None:
            at = at[in_bitmap(bits, whole[at])]
        out.append((owner[at], whole[at], at, None))
    return out


def _column(found, rows: int, first: np.ndarray) -> pa.Array:
    """The fingerprints as one list of structs per text."""
    empty = np.zeros(0, np.int64)
    text = np.concatenate([f[0] for f in found] or [empty])
    order = np.argsort(text, kind="stable")
    hashes = np.concatenate([f[1] for f in found] or [empty.view(np.uint64)]).view(np.int64)
    pos = np.concatenate([f[2] for f in found] or [empty])
    wide = np.concatenate([np.full(len(f[0]), f[3].shape[1] if f[3] is not None else 0) for f in found] or [empty])
    flat = np.concatenate([f[3].ravel() for f in found if f[3] is not None] or [empty])
    # Lists are taken in the order of the texts.
    around = W.lists(flat, wide, pa.int64()).take(pa.array(order))
    structs = pa.StructArray.from_arrays(
        [
            pa.array(hashes[order]),
            pa.array((pos - first[text])[order].astype(np.int32)),
            around,
        ],
        fields=list(_PRINT_ARROW),
    )
    counts = np.bincount(text, minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), structs)


def _fingerprints(df: DataFrame, ids: list[str], k, span, short, edge, items, bits=None) -> DataFrame:
    """ids, n_words and prints of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            w = W.split(batch.column("text"), W.ALNUM)
            found = _prints(w, k, span, short, edge, items, bits.value if bits is not None else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in ids]
                + [pa.array(w.counts), _column(found, batch.num_rows, w.first[:-1])],
                names=[*ids, "n_words", "prints"],
            )

    schema = T.StructType(
        [df.schema[i] for i in ids]
        + [T.StructField("n_words", T.LongType()), T.StructField("prints", T.ArrayType(_PRINT))]
    )
    return df.select(*ids, "text").mapInArrow(run, schema)


def _extend(batches: Iterator[pa.RecordBatch], k: int, span: int) -> Iterator[pa.RecordBatch]:
    """Joined fingerprints to the shared runs of words they lie in, where those are long enough."""
    side = span - k
    for batch in batches:
        pos = batch.column("pos").to_numpy()
        size = batch.column("size").to_numpy().astype(np.int64)
        keep, start, end = np.zeros(len(pos), bool), pos.astype(np.int64), pos + size
        keep[size < span] = True  # whole short items, equal by their hash
        long = np.flatnonzero(size >= span)
        if len(long):
            at = pa.array(long)
            width = span + side
            a, b = (
                batch.column(c).take(at).flatten().to_numpy().reshape(-1, width) for c in ("around", "item_around")
            )
            same = a == b
            left = np.cumprod(same[:, side - 1 :: -1], axis=1).sum(1) if side else np.zeros(len(long), np.int64)
            right = np.cumprod(same[:, side + k :], axis=1).sum(1)
            keep[long] = same[:, side : side + k].all(1) & (left + k + right >= span)
            start[long] = pos[long] - left
            end[long] = pos[long] + k + right
        out = pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(start), pa.array(end), batch.column("items")],
            names=["doc_id", "row_key", "start", "end", "items"],
        )
        yield out.filter(pa.array(keep))


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    k: int = K,
    span: int = SPAN,
) -> DataFrame:
    """Which words of which documents are shared with a benchmark.

    Returns doc_id, n_words, n_hit (words in a shared window), items (ids of the items with a
    window in the document, as sorted strings), spans (array of start, end: hit words from start
    up to end, disjoint and in order), row_key (a hash of id and text, by which `without` filters). A window is `span` consecutive words of an item, or all words
    of a shorter one.

    - Null and empty texts have no words: nothing hit, no spans; such items match nothing.
    - Rows that repeat a doc_id are results of their own when their texts differ; equal rows give
      equal results, one for each row.
    - Items of a null id hit words but are in no list; equal items are all listed.
    - An empty benchmark hits nothing; empty documents give no rows. Other columns are not read.

    Memory: 2 MB of text at a time, or one longer text. Documents are scanned once; only fingerprints
    whose bit is set in a bitmap of the items' (8 MB, however many) leave the scan. That join is on hashes,
    and adaptive execution splits hot ones: either side may have any size.
    """
    if not 1 <= k <= span:
        raise ValueError("k must lie between 1 and span")
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    item_words = _fingerprints(items, ["item_id"], k, span, list(range(1, span)), 1, True)
    # Equal fingerprints in equal surroundings are one row, with the ids of all their items.
    prints = cut(
        item_words.select("item_id", "n_words", F.explode("prints").alias("p"))
        .select(
            "p.hash",
            F.col("p.around").alias("item_around"),
            F.least(F.col("n_words"), F.lit(span)).cast("int").alias("size"),
            F.col("item_id").cast("string").alias("item_id"),
        )
        .groupBy("hash", "item_around", "size")
        .agg(F.collect_set("item_id").alias("items"))
    )
    lengths = prints.where(F.col("size") < span).select("size").distinct().collect()
    short = sorted(r["size"] for r in lengths)  # at most span - 1 numbers
    bits = documents.sparkSession.sparkContext.broadcast(bitmap(prints, "hash", BITMAP_LOG2))

    scanned = cut(_fingerprints(docs, ["doc_id", "row_key"], k, span, short, 0, False, bits))
    met = (
        scanned.select("doc_id", "row_key", F.explode("prints").alias("p"))
        .select("doc_id", "row_key", "p.hash", "p.pos", "p.around")
        .join(prints, "hash")
    )
    runs = met.mapInArrow(
        lambda batches: _extend(batches, k, span),
        T.StructType(
            [
                docs.schema["doc_id"],
                T.StructField("row_key", T.LongType()),
                T.StructField("start", T.LongType()),
                T.StructField("end", T.LongType()),
                T.StructField("items", T.ArrayType(T.StringType())),
            ]
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    merged = F.aggregate(
        F.array_sort("runs"),
        none,
        lambda done, run: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= run["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], run["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(run))),
    )
    hits = (
        runs.groupBy("doc_id", "row_key")
        .agg(
            F.collect_set(F.struct("start", "end")).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select(F.col("doc_id").alias("hit_id"), F.col("row_key").alias("hit_key"), merged.alias("spans"), "items")
    )
    return (
        scanned.select("doc_id", "row_key", "n_words")
        .join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row_key") == F.col("hit_key")), "left")
        .select(
            F.col("doc_id").alias(doc_id),
            "n_words",
            F.coalesce(
                F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0)
            ).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", none).alias("spans"),
            "row_key",
        )
    )


def without(
    documents: DataFrame, found: DataFrame, doc_id: str = "doc_id", most: float = 0.0, text: str = "text"
) -> DataFrame:
    """Documents of which at most the share `most` of the words is hit, with their columns.

    Rows are told apart by id and text, so a null or repeated id takes no other row with it.
    """
    bad = found.where(F.col("n_hit") > most * F.col("n_words")).select(F.col("row_key").alias("_bad")).distinct()
    return documents.join(bad, F.xxhash64(documents[doc_id], documents[text]) == bad["_bad"], "left_anti")
