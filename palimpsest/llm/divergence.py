"""How far the sources of a language differ in their words, from run-length encoded columns of counts.

A language's vocabulary is a table of terms by sources, almost all of it zero or small. Terms with the same counts in every
source are one row with a weight; rows are put in the order of their counts, the sources with the fewest words first, so
that equal counts lie together in every column, and each column of a block of rows is kept as runs. Two columns then meet
in the stretches between the borders of both; what a stretch adds to the divergence is computed once and multiplied by its
length.

Blocks are ranges of that order, and columns meet in tiles of a block and two groups of sources, so neither a large
vocabulary nor many sources nor one source with a third of all words is ever in one task. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm import words as W
from palimpsest.llm.shared import cut

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# Sources on either side of a tile, and text counted at a time.
TILE = 32
BATCH_BYTES = 2 << 20
# Letters of ASCII and every character beyond it.
LETTERS = W.ALNUM & ~((np.arange(256) >= 0x30) & (np.arange(256) <= 0x39))


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it) of lang, source, text, summed within batches only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", BATCH_BYTES):
            data, offsets = W.buffers(batch.column("text"))
            if not len(data):
                continue
            starts, ends = W.borders(data, offsets, LETTERS)
            stops = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            flat = np.ascontiguousarray(W.FOLD[data[LETTERS[data]]])
            coded = pa.Array.from_buffers(
                pa.large_string(), len(starts), [None, pa.py_buffer(stops), pa.py_buffer(flat)]
            ).dictionary_encode()
            langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            n_terms, n_sources = max(len(coded.dictionary), 1), len(sources.dictionary)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(starts, offsets)))
            # First what a document holds, then what a group of documents does.
            pair, times = np.unique(owner * n_terms + coded.indices.to_numpy(), return_counts=True)
            group = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
            cell, back = np.unique(group[pair // n_terms] * n_terms + pair % n_terms, return_inverse=True)
            lang, source = np.divmod(cell // n_terms, n_sources)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(lang)),
                    sources.dictionary.take(pa.array(source)),
                    coded.dictionary.take(pa.array(cell % n_terms)).cast(pa.string()),
                    pa.array(np.bincount(back, weights=times).astype(np.int64)),
                    pa.array(np.bincount(back).astype(np.int64)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    return documents.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def vocabulary(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, n, counts (source, n) of the terms in at least `least` documents of their language."""
    cells = term_counts(documents).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = cells.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return terms.where(F.col("docs") >= least).drop("docs")


def share(count: str, total: str, terms: str):
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) of columns; in decimals, since the product may pass 64 bits."""
    return F.expr(f"1 + cast({count} + 2 as decimal(20,0)) * cast({SCALE} as decimal(10,0)) div ({total} + 2 * {terms})")


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same in 64 bits: three digits of the scale at a time, so that no product passes them."""
    whole = total + 2 * terms
    rest = count + 2
    out = np.zeros(len(count), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def column_runs(at: np.ndarray, count: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of a column start and their counts, from its rows with counts; begin: the first term of each row."""
    rows = len(begin)
    places = np.unique(np.concatenate([[0], at, (at + 1)[at + 1 < rows]]))
    values = np.zeros(len(places), np.int64)
    values[np.searchsorted(places, at)] = count
    new = np.append(True, values[1:] != values[:-1])
    return begin[places[new]], values[new]


def _block_runs(rows: DataFrame) -> DataFrame:
    """lang, block, width (in terms), place, starts, values of each column that a block holds, from rows of lang, key, weight."""
    # Ranges are found from a sample that the driver holds: by the first two cells of a row and a hash, not by all its cells.
    short = [F.get("key", 0), F.get("key", 1), F.xxhash64("key")]
    ordered = rows.repartitionByRange("lang", *short).sortWithinPartitions("lang", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            cuts = [0, *(np.flatnonzero(langs[1:] != langs[:-1]) + 1).tolist(), len(langs)]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                weights = part.column("weight").to_numpy()
                begin = np.cumsum(weights) - weights
                cells, sizes = part.column("key").flatten(), part.column("key").value_lengths().to_numpy()
                place, count = cells.field("place").to_numpy(), cells.field("n").to_numpy()
                row = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((row, place))
                names, first = np.unique(place[order], return_index=True)
                found = [column_runs(row[c], count[c], begin) for c in np.split(order, first[1:])]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([langs[low]] * n, pa.string()),
                        pa.array([f"{task}-{k}"] * n, pa.string()),
                        pa.array([int(weights.sum())] * n, pa.int64()),
                        pa.array(names, pa.int32()),
                        pa.array([f[0] for f in found], pa.list_(pa.int64())),
                        pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    ],
                    names=["lang", "block", "width", "place", "starts", "values"],
                )

    return ordered.mapInArrow(
        run, "lang string, block string, width long, place int, starts array<long>, values array<long>"
    )


def met(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int) -> int:
    """What two columns (starts of runs, shares) add up to over a block: one product for each stretch between borders."""
    starts = np.union1d(a[0], b[0])
    lengths = np.diff(np.append(starts, width))
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    return int(((p - q) * (p - q) // (p + q) * lengths).sum())


def _tile(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over one block of the pairs of a source in the tile's first group with a later one in its second."""
    lang, width, low, high = frame[["lang", "width", "low", "high"]].iloc[0]
    held = {
        r.place: (np.asarray(r.starts, np.int64), shares(np.asarray(r.values, np.int64), r.total, r.terms))
        for r in frame.itertuples(index=False)
    }
    side = {g: sorted(frame.loc[frame["group"] == g, "place"]) for g in (low, high)}
    out = [(lang, a, b, met(held[a], held[b], width)) for a in side[low] for b in side[high] if a < b]
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def pair_sums(terms: DataFrame, groups: DataFrame, tile: int = TILE) -> DataFrame:
    """lang, a, b, value for every two places of sources (a below b) of a language with terms."""
    named = terms.select("lang", "term", F.explode("counts").alias("c")).select("lang", "term", "c.source", "c.n")
    placed = named.join(groups.select("lang", "source", "place"), ["lang", "source"])
    keyed = placed.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("key"))
    runs = cut(_block_runs(keyed.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("weight"))))
    blocks = runs.select("lang", "block", "width").distinct()
    # A source that does not occur in a block has one run of zeros there.
    zero = F.array(F.lit(0).cast("long"))
    columns = (
        blocks.join(groups, "lang")
        .join(runs.drop("width"), ["lang", "block", "place"], "left")
        .withColumns({"starts": F.coalesce("starts", zero), "values": F.coalesce("values", zero)})
        .withColumn("group", F.expr(f"(place - 1) div {tile}"))
    )
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(sources - 1) div {tile}")))
    tiles = columns.withColumn("other", others).withColumns(
        {"low": F.least("group", "other"), "high": F.greatest("group", "other")}
    )
    sums = tiles.drop("source", "other", "sources").groupBy("lang", "block", "low", "high")
    return sums.applyInPandas(_tile, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value")
    )


def audit(
    documents: DataFrame, text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, tile: int = TILE
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others, and by which terms.

    Terms are runs of ASCII letters and of characters beyond ASCII, with A-Z lower-cased; a language keeps those in at least
    `least` of its documents. A source's share of a term is 1 + floor(10^9 (count + 2) / (N + 2 V)), N its kept words and V
    the kept terms of the language. Two shares p and q add floor((p - q)^2 / (p + q)). Part `pair` has every other source of
    the language with the sum over all kept terms (0 where there are none); part `term` the `top` kept terms that a source
    uses more than its language does, with what each adds. Ranks follow the value, then the item in UTF-8. Null text,
    lang and source are ''. Every row counts, repeated ones too. Other columns are left out. A language with one source
    has no pairs; an empty table has no rows.
    """
    empty = F.lit("")
    docs = documents.select(
        *[F.coalesce(F.col(c).cast("string"), empty).alias(name) for c, name in (("lang", "lang"), ("source", "source"), (text, "text"))]
    )
    terms = cut(vocabulary(docs, least))
    cells = terms.select("lang", "term", F.col("n").alias("everywhere"), F.explode("counts").alias("c")).select(
        "lang", "term", "everywhere", "c.source", "c.n"
    )
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    languages = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("words"))
    every = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(languages, "lang", "left")
    of_lang = Window.partitionBy("lang")
    # The smallest sources come first: their counts are zero in the longest stretches.
    groups = cut(
        every.fillna(0, ["total", "terms", "words"])
        .withColumn("place", F.row_number().over(of_lang.orderBy("total", "source")))
        .withColumn("sources", F.count(F.lit(1)).over(of_lang))
    )

    a, b = (groups.select("lang", F.col("source").alias(x), F.col("place").alias(f"at_{x}")) for x in ("source", "item"))
    both = a.join(b, "lang").where(F.col("at_source") != F.col("at_item"))
    sums = pair_sums(terms, groups.drop("words"), tile).withColumnsRenamed({"a": "low", "b": "high"})
    pairs = (
        both.withColumns({"low": F.least("at_source", "at_item"), "high": F.greatest("at_source", "at_item")})
        .join(sums, ["lang", "low", "high"], "left")
        .fillna(0, ["value"])
    )
    own = cells.join(groups, ["lang", "source"]).withColumns(
        {"p": share("n", "total", "terms"), "q": share("everywhere", "words", "terms")}
    )
    more = own.where("p > q").withColumns({"item": F.col("term"), "value": F.expr("(p - q) * (p - q) div (p + q)")})

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = []
    for part, rows in (("pair", pairs), ("term", more)):
        ranked = rows.withColumns({"rank": F.row_number().over(order), "part": F.lit(part)})
        ranked = ranked.where(F.col("rank") <= top) if part == "term" else ranked
        found.append(ranked.select("lang", "source", "part", "item", "value", "rank"))
    return found[0].union(found[1])
