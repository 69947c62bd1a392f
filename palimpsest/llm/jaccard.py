"""Similarity join of documents by the Jaccard index of their word n-grams, for components.

Every document is the set of its distinct shingles. Equal sets become one class. Candidate pairs of classes meet in
tiles: of one shingle and one band of sizes with itself or the next, cut into blocks of bounded size, so only sizes within the
threshold of each other are paired and a frequent shingle is many tiles. A pair leaves its tile when the bit count
of its signatures allows enough overlap: a signature holds the parity of the number of shingles at each hashed place,
two to four places for each shingle, so every differing bit proves a differing shingle. What passes is intersected exactly.

Tiles come in two rounds. First each class is paired with one hub in the tiles of its smallest shingles, which joins
groups of near copies in linear work, however large they are. Then prefixes (Jaccard at least t makes the first
n - ceil(t n) + 1 shingles of two sets, in any common order, share one) give every pair that can still link
two components: the nearest partner of each class in a tile first, then, between the components that are left, all. Shingles that are frequent in a sample come last in that order, so they make no large tiles; the
order has no influence on the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W
from palimpsest.llm.graph import components
from palimpsest.llm.shared import bitmap, cut, few_tasks, in_bitmap

SHINGLE = 5
PERCENT = 80
# Smallest shingles of a set in whose tiles it meets a hub.
SKETCH = 8
# One set in SAMPLE tells frequent shingles: those in LEAST sampled sets, at most 2**20 of them (8 MB).
SAMPLE = 64
LEAST = 4
FREQUENT = 1 << 20
BITMAP_LOG2 = 26
# Signatures up to so many words of 64 places go into tiles as they are.
SHORT = 16
# Rows of one tile on either side, by expectation, and bytes of signatures compared at a time.
BLOCK = 2048
COMPARED = 8 << 20


def shingle_sets(w: W.Words, size: int, late: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles by text, in ascending order (those in `late` last), and their numbers.

    Shingles are numbers below 2**62, with bit 62 set on the late ones.
    """
    owner = w.owner
    ok = W.within(owner, size)
    grams = [W.ngrams(w.hashes, size)[ok]]
    owners = [owner[: len(ok)][ok]]
    for n in range(1, size):  # fewer words: all of them as one
        short = np.flatnonzero(w.counts == n)
        if len(short):
            grams.append(W.ngrams(w.hashes, n)[w.first[short]])
            owners.append(short)
    value, text = np.concatenate(grams) >> np.uint64(2), np.concatenate(owners)
    if len(late):
        at = np.searchsorted(late, value)
        at[at == len(late)] = 0
        value = value | ((late[at] == value).astype(np.uint64) << np.uint64(62))
    order = np.lexsort((value, text))
    value, text = value[order].view(np.int64), text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.bincount(text[new], minlength=len(w.first) - 1)


def _signature(values: np.ndarray) -> bytes:
    """Parity of the values at each of the places, as bits; places: a power of two from 64 on."""
    places = max(64, 2 << int(len(values) - 1).bit_length())
    odd = np.bincount(values & (places - 1), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _short(signature: bytes, n: int) -> bytes:
    """The signature of n values with half of its places, or a quarter where that is not far fewer than values; 1024 at least, if it has them."""
    bits = np.frombuffer(signature, np.uint64)
    quarter = len(bits) // 4
    width = quarter if 10 * n <= 14 * 64 * quarter else len(bits) // 2
    return _folded(bits[None, :], min(len(bits), max(width, SHORT)))[0].tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Signatures (rows) as they would be with fewer places."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, width), axis=1)


def _apart(signatures: pa.Array, left: np.ndarray, right: np.ndarray, others: pa.Array | None = None) -> np.ndarray:
    """Bits in which signatures differ, pair by pair; the longer of two is folded to the length of the shorter."""

    def by_width(column):
        data, offsets = column.buffers()[2], np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        whole, sizes = np.frombuffer(data, np.uint8), np.diff(offsets)
        row = np.zeros(len(column), np.int64)
        tables = {}
        for size in np.unique(sizes).tolist():
            some = np.flatnonzero(sizes == size)
            row[some] = np.arange(len(some))
            place = offsets[some][:, None] + np.arange(size)[None, :]
            tables[size] = whole[place].view(np.uint64)
        return sizes, row, tables

    one = by_width(signatures)
    two = one if others is None else by_width(others)
    out = np.zeros(len(left), np.int64)
    wide = one[0][left] * np.int64(1 << 32) + two[0][right]
    for both in np.unique(wide).tolist():
        x, y = one[2][both >> 32], two[2][both & 0xFFFFFFFF]
        width = min(x.shape[1], y.shape[1])
        x, y = _folded(x, width), _folded(y, width)
        some = np.flatnonzero(wide == both)
        step = max(1, COMPARED // (width * 8))
        for at in range(0, len(some), step):
            part = some[at : at + step]
            out[part] = np.bitwise_count(x[one[1][left[part]]] ^ y[two[1][right[part]]]).sum(1)
    return out


def _per_text(values: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    for n in counts.tolist():
        yield values[at : at + n]
        at += n


def _binary(parts: list) -> pa.Array:
    return pa.array([None if p is None else bytes(p) for p in parts], pa.binary())


def _features(docs: DataFrame, size: int) -> DataFrame:
    """By row: the set's size, two sums that name it, its smallest shingles, its signature, and some whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in W.slices(batches, "text"):
            values, counts = shingle_sets(W.split(batch.column("text"), W.SPACED), size, none)
            total = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(W.mix(values.view(np.uint64)), out=total[0, 1:])
            np.cumsum(W.mix(values.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
            ends = np.concatenate([[0], np.cumsum(counts)])
            a, b = (t[ends[1:]] - t[ends[:-1]] for t in total)
            sketch, sig, short, sample = [], [], [], []
            for own, name in zip(_per_text(values, counts), a.tolist()):
                sketch.append(own[:SKETCH])
                sig.append(_signature(own) if len(own) else None)
                short.append(_short(sig[-1], len(own)) if len(own) else None)
                sample.append(own if name % SAMPLE == 0 else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array(counts),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.array(sketch, pa.list_(pa.int64())),
                    _binary(sig),
                    _binary(short),
                    pa.array(sample, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "n", "a", "b", "sketch", "sig", "short", "sample"],
            )

    longs = T.ArrayType(T.LongType())
    kinds = [("row_key", T.LongType()), ("n", T.LongType()), ("a", T.LongType()), ("b", T.LongType())]
    kinds += [("sketch", longs), ("sig", T.BinaryType()), ("short", T.BinaryType()), ("sample", longs)]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(k, t) for k, t in kinds]])
    return docs.select("doc_id", "row_key", "text").mapInArrow(run, schema)


def _prefixes(docs: DataFrame, wanted, late, size: int, percent: int) -> DataFrame:
    """row_key, n and each shingle of the prefix, of the rows whose key is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            keys = batch.column("row_key").to_numpy()
            batch = batch.filter(pa.array(in_bitmap(wanted.value, keys.view(np.uint64))))
            if not batch.num_rows:
                continue
            values, counts = shingle_sets(W.split(batch.column("text"), W.SPACED), size, late.value)
            length = counts - (percent * counts + 99) // 100 + 1
            length[counts == 0] = 0
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            total = int(length.sum())
            place = np.repeat(starts - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[place]),
                    pa.array(np.repeat(batch.column("row_key").to_numpy(), length)),
                    pa.array(np.repeat(counts, length).astype(np.int32)),
                ],
                names=["t", "row_key", "n"],
            )

    schema = T.StructType(
        [T.StructField("t", T.LongType()), T.StructField("row_key", T.LongType()), T.StructField("n", T.IntegerType())]
    )
    return docs.select("row_key", "text").mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted, size: int) -> DataFrame:
    """row_key and the whole set, of the rows whose key is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in W.slices(batches, "text"):
            keys = batch.column("row_key").to_numpy()
            batch = batch.filter(pa.array(in_bitmap(wanted.value, keys.view(np.uint64))))
            if batch.num_rows:
                values, counts = shingle_sets(W.split(batch.column("text"), W.SPACED), size, none)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_key"), _binary(list(_per_text(values, counts)))], names=["row_key", "shingles"]
                )

    schema = T.StructType([T.StructField("row_key", T.LongType()), T.StructField("shingles", T.BinaryType())])
    return docs.select("row_key", "text").mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cuts sorted rows so that all rows of one value are in one batch with others, or alone."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        border = int(np.searchsorted(values, values[-1]))
        if rest and rest[-1].column(column)[-1].as_py() != values[0]:
            yield from pa.Table.from_batches(rest).combine_chunks().to_batches()
            rest = []
        if border:
            yield from pa.Table.from_batches([*rest, batch.slice(0, border)]).combine_chunks().to_batches()
            rest = [batch.slice(border)]
        else:
            rest.append(batch)
    if rest:
        yield from pa.Table.from_batches(rest).combine_chunks().to_batches()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by t, those whose t more than one row has. Holds one batch and one row."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = batch.column("t").to_numpy()
        same = t[1:] == t[:-1]
        keep = np.zeros(len(t), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if held is not None:
            row, kept = held
            if row.column("t")[0].as_py() == t[0]:
                keep[0] = kept = True
            if kept:
                yield row
        yield batch.slice(0, len(t) - 1).filter(pa.array(keep[:-1]))
        held = batch.slice(len(t) - 1), bool(keep[-1])
    if held is not None and held[1]:
        yield held[0]


# A pair of classes with their components, then with the keys of their rows, then the components alone.
_PAIR = T.StructType([T.StructField(k, T.LongType()) for k in ("x", "y", "cx", "cy")])
_LEFT = T.StructType([T.StructField(k, T.LongType()) for k in ("kx", "ky", "cx", "cy")])
_LINK = T.StructType([T.StructField(k, T.LongType()) for k in ("cx", "cy")])


def _possible(nx: np.ndarray, ny: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes, with at least `apart` shingles in one only, can be similar enough."""
    both = nx + ny
    most = np.minimum((both - apart) // 2, np.minimum(nx, ny))
    return 100 * most >= percent * (both - most)


def _tile_pairs(batches: Iterator[pa.RecordBatch], percent: int, nearest: bool = False) -> Iterator[pa.RecordBatch]:
    """Pairs of classes of one tile that lie in different components and whose signatures leave room.

    `nearest` keeps for each row only the partner whose signature differs least: as many pairs as rows.
    Rows come sorted by tile and side. Those of side 0 are paired with those of side 1; in a tile with one side only (2) each
    with those behind it.
    """
    for batch in _runs(batches, "tile"):
        tile, side = batch.column("tile").to_numpy(), batch.column("side").to_numpy()
        n, c, comp = (batch.column(k).to_numpy().astype(np.int64) for k in ("n", "c", "comp"))
        here = np.arange(len(tile))
        starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(tile)]]))
        stop = np.repeat(starts + sizes, sizes)
        second = np.repeat(starts + np.add.reduceat((side == 0).astype(np.int64), starts), sizes)
        begin = np.where(side == 2, here + 1, second)
        partners = np.where(side == 1, 0, stop - begin)
        ends = np.cumsum(partners)
        at = 0
        while at < len(tile):
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + (1 << 18), "right")))
            many = partners[at:upto]
            left = np.repeat(here[at:upto], many)
            right = np.repeat(begin[at:upto] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            at = upto
            ok = (comp[left] != comp[right]) & _possible(n[left], n[right], np.int64(0), percent)
            left, right = left[ok], right[ok]
            if not len(left):
                continue
            apart = _apart(batch.column("sig"), left, right)
            ok = _possible(n[left], n[right], apart, percent)
            left, right, apart = left[ok], right[ok], apart[ok]
            if nearest and len(left):
                row, other = np.concatenate([left, right]), np.concatenate([right, left])
                order = np.lexsort((np.concatenate([apart, apart]), row))
                first = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])]
                left, right = row[first], other[first]
            swap = c[left] > c[right]
            x, y = np.where(swap, right, left), np.where(swap, left, right)
            if len(x):
                pair = np.unique(np.stack([c[x], c[y], comp[x], comp[y]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(k) for k in pair], names=_PAIR.names)


def _tiles(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows (t, n, c, comp) of shingles that reach over components, once for each tile they belong to.

    Bands are a little wider than the threshold: sizes that can link lie in one band or two neighbouring ones. A band
    of a shingle with more than BLOCK rows has several blocks, and every pair of blocks is a tile. The bands of a shingle
    with fewer rows in all are one tile, in which sizes are compared as they are.
    """
    banded = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / np.log(100.01 / percent)).cast("int"))
    counted = banded.groupBy("t", "band").agg(
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
        F.count(F.lit(1)).alias("rows"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
    )
    # A shingle has as many bands as sizes differ by the threshold: a hundred at most.
    mixed = (
        counted.groupBy("t")
        .agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("rows").alias("rows"),
            F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks"),
        )
        .where(F.col("low") < F.col("high"))
        .select("t", (F.col("rows") <= BLOCK).alias("small"), "blocks")
    )
    # Every row of a tile carries a signature: the short one.
    live = banded.join(mixed, "t").join(classes.select("c", F.col("short").alias("sig")), "c")
    many = lambda band: F.coalesce(F.try_element_at("blocks", band), F.lit(0))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    band, own = F.col("band"), F.pmod(F.xxhash64("c"), many(F.col("band"))).cast("int")

    def place(low, high, i, j, side):
        return F.struct(F.xxhash64(F.col("t"), low, high, i, j).alias("tile"), side.cast("tinyint").alias("side"))

    within = F.transform(
        upto(many(band)),
        lambda k: place(
            band, band, F.least(own, k), F.greatest(own, k), F.when(own == k, F.lit(2)).when(own < k, F.lit(0)).otherwise(F.lit(1))
        ),
    )
    above = F.transform(upto(many(band + 1)), lambda k: place(band, band + 1, own, k, F.lit(0)))
    below = F.transform(upto(many(band - 1)), lambda k: place(band - 1, band, k, own, F.lit(1)))
    none = F.lit(-1)
    places = F.when(F.col("small"), F.array(place(none, none, none, none, F.lit(2)))).otherwise(F.concat(within, above, below))
    return live.select("n", "c", "comp", "sig", F.explode(places).alias("p")).select(
        "p.tile", "p.side", "n", "c", "comp", "sig"
    )


def _bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keys and components of pairs whose sizes and signatures leave room for enough overlap."""
    for batch in batches:
        nx, ny = (batch.column(k).to_numpy() for k in ("nx", "ny"))
        some = np.flatnonzero(_possible(nx, ny, np.int64(0), percent))
        apart = _apart(batch.column("sx"), some, some, batch.column("sy"))
        keep = some[_possible(nx[some], ny[some], apart, percent)]
        yield batch.select(_LEFT.names).take(pa.array(keep))


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Components of pairs whose sets are similar enough, by intersection of the sorted arrays."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a, b = (np.frombuffer(batch.column(k)[i].as_py(), np.int64) for k in ("px", "py"))
            inter = len(np.intersect1d(a, b, assume_unique=True))
            keep[i] = 100 * inter >= percent * (len(a) + len(b) - inter)
        yield batch.select(_LINK.names).filter(pa.array(keep))


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, rows: int, size: int, percent: int) -> DataFrame:
    """The components that a pair of classes links: bit counts first, then sets of the classes that are left.

    `rows` is about how many pairs there are, and sets the number of tasks.
    """
    context = docs.sparkSession.sparkContext

    def of(side: str) -> DataFrame:
        return classes.select(*[F.col(k).alias(v) for k, v in (("c", side), ("row_key", f"k{side}"), ("n", f"n{side}"), ("sig", f"s{side}"))])

    met = few_tasks(pairs.join(of("x"), "x").join(of("y"), "y"), rows)
    left = cut(met.mapInArrow(lambda b: _bounded(b, percent), _LEFT))
    ends = left.select(F.explode(F.array("kx", "ky")).alias("row_key"))
    wanted = context.broadcast(bitmap(ends, "row_key", BITMAP_LOG2))
    # Both sides read one shuffle of the sets.
    sets = _sets(docs, wanted, size).dropDuplicates(["row_key"])
    both = left.join(sets.select(F.col("row_key").alias("kx"), F.col("shingles").alias("px")), "kx").join(
        sets.select(F.col("row_key").alias("ky"), F.col("shingles").alias("py")), "ky"
    )
    return cut(few_tasks(both, left.count()).mapInArrow(lambda b: _linked(b, percent), _LINK), left)


def _frequent(classes: DataFrame) -> np.ndarray:
    """Shingles frequent in the sampled sets, sorted; the most frequent where there are more than FREQUENT."""
    counts = (
        classes.where(F.col("sample").isNotNull())
        .select(F.explode("sample").alias("t"))
        .groupBy("t")
        .agg(F.count(F.lit(1)).alias("k"))
        .where(F.col("k") >= LEAST)
    )
    # How often each count (up to 100,000) occurs says from which count on the list fits.
    capped = F.least(F.col("k"), F.lit(100_000)).alias("k")
    total, least = 0, 1 << 60
    for r in sorted(counts.select(capped).groupBy("k").count().collect(), key=lambda r: -r["k"]):
        total += r["count"]
        if total > FREQUENT:
            break
        least = r["k"]
    found = counts.where(F.col("k") >= least).select("t").toPandas()["t"].to_numpy(np.int64)
    return np.sort(found).view(np.uint64)


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every row.

    Two rows link when 100 * |intersection| >= percent * |union| of their sets of shingles: `size`
    consecutive words (split at ASCII white space, A-Z lower-cased), or all words of a shorter text. Null and
    empty texts, and texts of white space, have empty sets, link with nothing and are their own component.

    - Rows that repeat a doc_id stand each for itself; equal texts are one class in any case.
    - A null id is not the smallest one of its component unless all its ids are null.
    - Empty tables give no rows. Other columns are not read.

    Sets are compared by 62-bit hashes of their shingles. Documents are scanned five times and never shuffled;
    what is shuffled are prefixes (a fifth of the shingles) and the sets of candidates. Hubs, tiles and pairs go
    through joins that adaptive execution splits.
    """
    features, labelled = _labelled(documents, doc_id, text, size, percent)
    lowest = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    of_set = labelled.join(lowest, "label").select("a", "b", "n", "component_id")
    return features.select("doc_id", "a", "b", "n").join(of_set, ["a", "b", "n"], "left").select(
        F.col("doc_id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _labelled(documents: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Features of every row (doc_id, row_key, a, b, n), and the label of the component of every set (a, b, n)."""
    context = documents.sparkSession.sparkContext
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    features = cut(_features(docs, size))
    grouped = (
        features.where(F.col("n") > 0)
        .groupBy("a", "b", "n")
        .agg(
            F.min("doc_id").alias("low"),
            F.min("row_key").alias("row_key"),
            *[F.first(k).alias(k) for k in ("sketch", "sig", "short", "sample")],
        )
    )
    classes = cut(few_tasks(grouped, features.count()).withColumn("c", F.monotonically_increasing_id()))
    # Rows of prefixes: one place more than the share that may differ.
    known = classes.agg(F.count(F.lit(1)).alias("rows"), F.sum((100 - percent) * F.col("n") / 100 + 1).alias("prefixes")).first()

    # Round 1: one hub for each class in each of its tiles.
    sketch = classes.select("c", "n", F.explode("sketch").alias("t"))
    hubs = (
        sketch.groupBy("t")
        .agg(F.min(F.struct(F.xxhash64("c", "t").alias("k"), "c", "n")).alias("hub"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
        .select("t", F.col("hub.c").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    near = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    stars = (
        sketch.join(hubs, "t")
        .where((F.col("c") != F.col("hub")) & near)
        .select(F.least("c", "hub").alias("x"), F.greatest("c", "hub").alias("y"))
        .distinct()
        .select("x", "y", F.col("x").alias("cx"), F.col("y").alias("cy"))
    )
    first = components(_links(docs, classes, stars, SKETCH * known["rows"], size, percent))

    # Round 2: prefixes, for pairs between components.
    wanted = context.broadcast(bitmap(classes, "row_key", BITMAP_LOG2))
    late = context.broadcast(_frequent(classes))
    dealt = few_tasks(_prefixes(docs, wanted, late, size, percent).repartition(F.col("t")), int(known["prefixes"] or 0))
    postings = dealt.sortWithinPartitions("t").mapInArrow(_shared, "t bigint, row_key bigint, n int")
    placed = classes.select("row_key", "c").join(first.withColumnRenamed("node", "c"), "c", "left")
    rows = few_tasks(postings.join(placed, "row_key"), int(known["prefixes"] or 0))
    rows = cut(rows.select("t", "n", "c", F.coalesce("label", "c").alias("comp")))
    many = rows.count()

    def met(rows: DataFrame, nearest: bool) -> DataFrame:
        tiles = few_tasks(_tiles(rows, classes, percent).repartition(F.col("tile")), many)
        pairs = tiles.sortWithinPartitions("tile", "side").mapInArrow(lambda b: _tile_pairs(b, percent, nearest), _PAIR)
        return pairs.distinct()

    def relabelled(rows: DataFrame, found: DataFrame, comp: str) -> DataFrame:
        """Components of components: `found` says which of them are one."""
        new = found.select(F.col("node").alias(comp), F.col("label").alias("_label"))
        return rows.join(new, comp, "left").withColumn(comp, F.coalesce("_label", comp)).drop("_label")

    # The nearest partners come before all others: they join most of what is left, and so leave few pairs. From here on
    # nodes are the components so far, so each round's graph has its own new links and no others.
    second = components(_links(docs, classes, met(rows, True), many, size, percent))
    last = components(_links(docs, classes, met(relabelled(rows, second, "comp"), False), many, size, percent))

    labelled = classes.select("a", "b", "n", "low", "c").join(first.withColumnRenamed("node", "c"), "c", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "c"))
    return features, relabelled(relabelled(labelled, second, "label"), last, "label")


def representatives(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", nulls_stay: bool = True) -> DataFrame:
    """One row of each component, with all its columns: the smallest id, of rows that repeat it the smallest hash of id and text.

    Of rows with one id and text one stays. Rows without shingles are components of their own and stay. Rows of a null id
    all stay; with `nulls_stay` off they are rows of their components as others are, chosen where no row has an id.
    """
    features, labelled = _labelled(documents, doc_id, text, SHINGLE, PERCENT)
    rows = features.where(F.col("doc_id").isNotNull()) if nulls_stay else features
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("best")
    sets = rows.where(F.col("n") > 0).groupBy("a", "b", "n").agg(best)
    chosen = sets.join(labelled.select("a", "b", "n", "label"), ["a", "b", "n"]).groupBy("label").agg(F.min("best").alias("best"))
    chosen = chosen.select(F.col("best.row_key").alias("_row_key"))
    alone = rows.where(F.col("n") == 0).select(F.col("row_key").alias("_row_key"))
    again = rows.where(F.col("n") > 0).groupBy(F.col("row_key").alias("_row_key")).agg(F.count(F.lit(1)).alias("rows"))
    again = again.where(F.col("rows") > 1).select("_row_key")
    keyed = documents.withColumn("_row_key", F.xxhash64(F.col(doc_id), F.col(text)))
    keyed = keyed.where(F.col(doc_id).isNotNull()) if nulls_stay else keyed
    same = keyed.join(chosen.union(alone).distinct(), "_row_key", "left_semi")
    # Only repeated rows are shuffled once more with their texts.
    single = same.join(again, "_row_key", "left_anti")
    repeated = same.join(again, "_row_key", "left_semi").dropDuplicates(["_row_key"])
    out = single.unionByName(repeated).select(*documents.columns)
    return out.unionByName(documents.where(F.col(doc_id).isNull())) if nulls_stay else out
