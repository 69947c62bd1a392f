"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Rotations of the principal axes are learned that bring vectors near the corners of a cube; the signs are
balanced binary codes. Codes are cut into chunks, and every chunk indexes a table of its own. A vector looks itself up in
every table under its own chunk and under those with some of its least certain bits turned. What it meets and what agrees in
enough bits of the whole code is compared with the original vectors.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.graph import components
from palimpsest.llm.shared import cut

COSINE = 0.9
# Fitting takes about so many vectors, chosen by a hash.
SAMPLE = 20_000
ROUNDS = 30
# A vector has at least so many rotations, of 64 bits each; turned are all sets of the least certain FLIPS bits of a chunk.
ROTATIONS = 3
FLIPS = 3
# Rotations are added, up to MOST, until pairs made at the threshold meet with this share; chunks narrow where MOST do not do.
EXPECTED = 0.95
MOST = 24
# So many vectors of the sample get made partners.
MEASURED = 1_000
# Codes of vectors at the threshold differ in angle / pi of their bits; so many deviations more are let through.
DEVIATIONS = 5.0


def _rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """Projection of centred vectors on 64 signed axes (principal axes, rotated); fewer axes repeat in another rotation."""
    d = x.shape[1]
    bits = min(64, d)
    _, vectors = np.linalg.eigh(x.T @ x / max(len(x), 1))
    axes = vectors[:, ::-1][:, :bits]
    v = x @ axes
    rng = np.random.default_rng(seed)
    out = []
    while sum(o.shape[1] for o in out) < 64:
        r = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
        for _ in range(ROUNDS if len(x) else 0):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    return np.concatenate(out, axis=1)[:, :64]


def fit(sample: np.ndarray, rotations: int = ROTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection (one column per bit) for unit vectors of one length."""
    centre = sample.mean(0) if len(sample) else np.zeros(sample.shape[1])
    return centre, np.concatenate([_rotation(sample - centre, k) for k in range(rotations)], axis=1)


def _chunks(far: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of every table's chunk (vectors, tables, width) and the places of its least certain ones."""
    tables = far.shape[1] // width
    chunk = far[:, : tables * width].reshape(len(far), tables, width)
    sure = np.abs(chunk)
    weak = np.argpartition(sure, FLIPS, axis=2)[:, :, :FLIPS] if width > FLIPS else np.argsort(sure, axis=2)
    return chunk >= 0, weak


def _pairs(sample: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors with partners at the cosine: turned towards other vectors of the sample, and turned anywhere.

    Each kind comes twice: for vectors of the whole sample, and for the tenth nearest its centre, where centring
    widens angles most.
    """
    rng = np.random.default_rng(7)
    d = sample.shape[1]
    if d < 2:
        return []
    if len(sample) < 2:
        sample = rng.standard_normal((MEASURED, d))
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    near = np.argsort(np.linalg.norm(sample - sample.mean(0), axis=1), kind="stable")[: max(1, len(sample) // 10)]
    out = []
    for some in (np.arange(len(sample)), near):
        x = sample[rng.choice(some, MEASURED)]
        for to in (sample[rng.integers(0, len(sample), len(x))], rng.standard_normal(x.shape)):
            aside = to - (to * x).sum(1, keepdims=True) * x
            size = np.linalg.norm(aside, axis=1, keepdims=True)
            ok = size[:, 0] > 1e-6
            if ok.any():
                out.append((x[ok], cosine * x[ok] + math.sqrt(1 - cosine**2) * aside[ok] / size[ok]))
    return out


def _measured(pairs: list[tuple[np.ndarray, np.ndarray]], model: tuple[np.ndarray, np.ndarray], width: int) -> tuple[float, float]:
    """The least share of a kind of pairs that meets in a table, and the share of bits that stays over DEVIATIONS of theirs."""
    centre, axes = model
    recall, apart = 1.0, 0.0
    for x, y in pairs:
        fx, fy = (x - centre) @ axes, (y - centre) @ axes
        (bx, wx), (by, wy) = _chunks(fx, width), _chunks(fy, width)
        differ = bx != by
        n = differ.sum(2)
        met = (np.take_along_axis(differ, wx, 2).sum(2) == n) | (np.take_along_axis(differ, wy, 2).sum(2) == n)
        recall = min(recall, float(met.any(1).mean()))
        share = ((fx >= 0) != (fy >= 0)).mean(1)
        apart = max(apart, float(share.mean() + DEVIATIONS * share.std()))
    return recall, apart


def _fitted(samples: dict[int, np.ndarray], cosine: float, width: int) -> tuple[dict[int, tuple], int, float]:
    """Models of each length, the width of chunks and the share of bits in which partners may differ.

    Models get as many rotations as pairs at the threshold need to meet at this width, the same number for each length.
    """
    models = {d: fit(x) for d, x in samples.items()}
    pairs = {d: _pairs(x, cosine) for d, x in samples.items()}
    rotations = ROTATIONS

    def worst() -> float:
        return min((_measured(pairs[d], models[d], width)[0] for d in models), default=1.0)

    while (recall := worst()) < EXPECTED:
        if rotations < MOST:
            # As many as would do if tables met independently of each other.
            enough = math.log(1 - EXPECTED) / math.log(1 - max(recall, 0.01))
            more = min(MOST, max(rotations + 1, int(rotations * enough)))
            for d, (centre, axes) in models.items():
                added = [_rotation(samples[d] - centre, k) for k in range(rotations, more)]
                models[d] = centre, np.concatenate([axes, *added], axis=1)
            rotations = more
        else:  # all bits of a chunk of FLIPS are turned, so this ends
            width -= 1
    return models, width, max((_measured(pairs[d], models[d], width)[1] for d in models), default=0.0)


def _codes(vectors: DataFrame, models: dict[int, tuple], width: int) -> DataFrame:
    """c, code (longs), keys (one per table) and probes (keys with bits turned) of every vector."""
    sent = vectors.sparkSession.sparkContext.broadcast(models)
    turns = [sum(1 << k for k in some) for n in range(FLIPS + 1) for some in itertools.combinations(range(FLIPS), n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("d").to_numpy()
            for d in np.unique(size).tolist():
                part = batch.filter(pa.array(size == d))
                x = part.column("v").flatten().to_numpy().reshape(-1, d).astype(np.float64)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                centre, axes = sent.value[d]
                far = (x - centre) @ axes
                code = np.packbits(far >= 0, axis=1, bitorder="little").view(np.int64)
                chunk, weak = _chunks(far, width)
                tables = chunk.shape[1]
                value = (chunk.astype(np.int64) << np.arange(width)).sum(2)
                # Tables and vector lengths have keys of their own.
                base = ((np.int64(d) << 16) + np.arange(tables)) << width
                keys = base + value
                masks = np.stack(
                    [sum(((t >> k) & 1) << weak[:, :, k].astype(np.int64) for k in range(weak.shape[2])) for t in turns], axis=2
                )
                probes = (base + (value[:, :, None] ^ masks).transpose(2, 0, 1)).transpose(1, 2, 0).reshape(len(x), -1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("c")]
                    + [
                        pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(m).ravel()), m.shape[1]).cast(
                            pa.list_(pa.int64())
                        )
                        for m in (code, keys, probes)
                    ],
                    names=["c", "code", "keys", "probes"],
                )

    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [vectors.schema["c"], T.StructField("code", longs), T.StructField("keys", longs), T.StructField("probes", longs)]
    )
    return vectors.select("c", "v", "d").mapInArrow(run, schema)


def _dot(a: str, b: str) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def near_duplicates(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    sample: int = SAMPLE,
    width: int | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link when the cosine of their vectors, in double precision, is at least `cosine` (over 0); all links reported
    are checked with the original vectors. Pairs are found through hash tables, so a pair near the threshold can be
    missed: the tests measure recall against brute force. n_links counts linked rows, component_id is the smallest id
    reachable, kept: it is the row's own.

    - Null, empty and zero vectors, and those with a null or non-finite component, link with nothing.
    - Vectors of different lengths do not link; each length has a model of its own.
    - Equal vectors are one class: looked up once and counted as often as they are there.
    - Rows that repeat an id stand each for itself. A null id is never a component's smallest unless all are null.
    - Empty tables give no rows. Other columns are not read.

    Fitting collects about `sample` vectors of each of the 16 most frequent lengths; others get unlearned axes. The width of
    chunks follows the number of vectors (or is given), so a table's buckets stay small on average; hot ones are split by adaptive execution.
    The number of tables follows from the width: rotations are added until pairs made at the threshold from the
    sample, those near its centre on their own, meet with a share of EXPECTED. Where MOST rotations are too few, chunks get narrower
    and buckets larger.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must lie in (0, 1]")
    rows = embeddings.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    classes = cut(
        rows.where(good)
        .groupBy("v")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"))
        .select(F.monotonically_increasing_id().alias("c"), "v", "low", "rows", F.size("v").alias("d"))
        .withColumn("norm", F.sqrt(_dot("v", "v")))
    )
    lengths = {r["d"]: r["count"] for r in classes.groupBy("d").count().collect()}
    often = sorted(lengths, key=lambda d: (-lengths[d], d))[:16]
    samples = {}
    for d in lengths:
        n = lengths[d]
        most = int(min(1, sample / n) * (1 << 30)) if d in often else 0
        part = classes.where((F.col("d") == d) & (F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < most)) if most else None
        x = np.array([r["v"] for r in part.select("v").collect()], np.float64) if most else np.zeros((0, d))
        x = x.reshape(-1, d)
        samples[d] = x / np.linalg.norm(x, axis=1, keepdims=True)
    width = width or min(max(8, math.ceil(math.log2(max(lengths.values(), default=2)))), 32)
    models, width, measured = _fitted(samples, cosine, width)

    codes = cut(_codes(classes, models, width))
    rotations = max((axes.shape[1] for _, axes in models.values()), default=64 * ROTATIONS) // 64
    bits = 64 * rotations
    share = math.acos(cosine) / math.pi
    # The formula is of angles at the origin; codes are of centred vectors, whose angles are measured.
    most = math.ceil(max(bits * share + DEVIATIONS * math.sqrt(bits * share * (1 - share)), bits * measured))
    index = codes.select(F.col("c").alias("x"), F.col("code").alias("cx"), F.explode("keys").alias("key"))
    probes = codes.select(F.col("c").alias("y"), F.col("code").alias("cy"), F.explode("probes").alias("key"))
    apart = sum((F.bit_count(F.col("cx")[k].bitwiseXOR(F.col("cy")[k])) for k in range(rotations)), F.lit(0))
    met = (
        index.join(probes, "key")
        .where((F.col("x") != F.col("y")) & (apart <= most))
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
    )
    of_x = classes.select(F.col("c").alias("x"), F.col("v").alias("vx"), F.col("norm").alias("nx"), F.col("rows").alias("rx"))
    of_y = classes.select(F.col("c").alias("y"), F.col("v").alias("vy"), F.col("norm").alias("ny"), F.col("rows").alias("ry"))
    links = cut(
        met.join(of_x, "x")
        .join(of_y, "y")
        .where(F.size("vx") == F.size("vy"))
        .where(_dot("vx", "vy") / (F.col("nx") * F.col("ny")) >= cosine)
        .select("x", "y", "rx", "ry")
    )
    others = (
        links.select(F.col("x").alias("c"), F.col("ry").alias("n"))
        .union(links.select("y", "rx"))
        .groupBy("c")
        .agg(F.sum("n").alias("others"))
    )
    label = components(links.select("x", "y")).withColumnRenamed("node", "c")
    labelled = classes.join(label, "c", "left").join(others, "c", "left").withColumn("label", F.coalesce("label", "c"))
    labelled = labelled.select("v", "low", "rows", "label", F.coalesce("others", F.lit(0)).alias("others"))
    lowest = labelled.groupBy("label").agg(F.min("low").alias("lowest"))
    found = labelled.join(lowest, "label").select(
        F.col("v").alias("of"), (F.col("rows") - 1 + F.col("others")).alias("links"), "lowest"
    )
    out = rows.select("id", F.when(good, F.col("v")).alias("v")).join(found, F.col("v") == F.col("of"), "left")
    component = F.coalesce("lowest", "id")
    return out.select(
        F.col("id").alias(vec_id),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("id").eqNullSafe(component)).alias("kept"),
    )
