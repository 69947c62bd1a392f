"""Scores of documents under a masked language model: the pseudo-likelihood of their words.

A small network sees the words on both sides of a place and gives a distribution over the word at it. A document's
score is the sum of the logarithms of what it gives to each word. Words outside a vocabulary, counted over
all documents, share buckets by hash; such a word has the probability of its bucket times its share of the bucket's counts.
The softmax has two levels: a class of words, then a word of the class.

The network is trained in numpy where the data lie: every partition of training windows trains a copy, the copies
are averaged in a tree of bounded width, and the average is where the next round begins. Every word of every document is a
training window in one of the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W
from palimpsest.llm.shared import cut, forget

# 64 classes of 64 words; the last class holds the buckets of words outside the vocabulary.
CLASSES = WITHIN = 64
VOCABULARY = CLASSES * WITHIN
NAMED = VOCABULARY - WITHIN
OUTSIDE = VOCABULARY
SIDE = 3
DIMENSIONS = 16
HIDDEN = 32
# A round trains on the words of one residue in RATE, the next round on those of the next: ROUNDS = RATE uses each word once.
RATE = 2
ROUNDS = 2
BATCH = 2048
STEP = 0.01
# Copies averaged by one task, and numbers of a copy in one row.
FAN = 32
BLOCK = 1 << 14
# Words that a task holds at once, or those of one longer text.
HELD = 1 << 19


@dataclass
class Network:
    words: np.ndarray  # vector of each word, and of the outside of a text
    inner: np.ndarray  # (places around, DIMENSIONS, HIDDEN)
    shift: np.ndarray
    classes: np.ndarray  # (HIDDEN + 1, CLASSES)
    within: np.ndarray  # (CLASSES, HIDDEN + 1, WITHIN)

    @classmethod
    def new(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def some(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            some(VOCABULARY + 1, DIMENSIONS, scale=0.3),
            some(2 * SIDE, DIMENSIONS, HIDDEN, scale=(2 * SIDE * DIMENSIONS) ** -0.5),
            np.zeros(HIDDEN, np.float32),
            some(HIDDEN + 1, CLASSES, scale=0.05),
            some(CLASSES, HIDDEN + 1, WITHIN, scale=0.05),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    @classmethod
    def unflat(cls, values: np.ndarray) -> Network:
        out, at = [], 0
        for f in fields(cls):
            shape = getattr(cls.new(), f.name).shape
            size = int(np.prod(shape))
            out.append(values[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(*out)

    def reach(self) -> np.ndarray:
        """What each word adds to the hidden layer at each place around."""
        return np.einsum("vd,pdh->pvh", self.words, self.inner)


def _exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray | np.floating]:
    """Puts exponentials of the rows above a shift in their place; gives their sums and the shift, 0 where no value is far from it."""
    shift = x.dtype.type(0)
    if x.size and (x.max() > 40 or x.min() < -40):
        shift = x.max(1)
        x -= shift[:, None]
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype), shift


def _errors(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Probabilities less one at the places, over the number of rows, in the place of x."""
    sums, _ = _exponentials(x)
    n = x.dtype.type(len(x))
    sums *= n
    x /= sums[:, None]
    x.reshape(-1)[np.arange(len(x)) * x.shape[1] + at] -= 1 / n
    return x


def _tanh(x: np.ndarray) -> None:
    """In the place of x, by the exponential, which is the faster of the two in numpy."""
    np.minimum(x, 20, out=x)
    x *= 2
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1


def _log_chosen(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities at the places; x is used up."""
    chosen = x[np.arange(len(x)), at]
    sums, shift = _exponentials(x)
    return chosen - shift - np.log(sums)


def _by_class(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of rows by class, and each class with the slice that it is there."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
    return order, [(g, begin, end) for g, (begin, end) in enumerate(zip([0, *ends], ends)) if end > begin]


def _wide(hidden: np.ndarray) -> np.ndarray:
    out = np.empty((len(hidden), HIDDEN + 1), hidden.dtype)
    out[:, :HIDDEN] = hidden
    out[:, HIDDEN] = 1
    return out


def log_probabilities(net: Network, reach: np.ndarray, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The logarithm of each target's probability given the ids around it (rows of 2 * SIDE)."""
    order, parts = _by_class(target // WITHIN)
    around, target = around[order], target[order]
    hidden = reach[0].take(around[:, 0], axis=0)
    hidden += net.shift
    for p in range(1, 2 * SIDE):
        hidden += reach[p].take(around[:, p], axis=0)
    _tanh(hidden)
    wide = _wide(hidden)
    by_class = _log_chosen(wide @ net.classes, target // WITHIN).astype(np.float64)
    own = np.empty((len(target), WITHIN), wide.dtype)
    for g, begin, end in parts:
        np.matmul(wide[begin:end], net.within[g], out=own[begin:end])
    out = np.empty(len(target))
    out[order] = by_class + _log_chosen(own, target % WITHIN)
    return out


def _gradient(net: Network, around: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean negative log-probability, in the order of the fields."""
    # Rows in the order of their classes, so that each class is a slice.
    order, parts = _by_class(target // WITHIN)
    around, target = around[order], target[order]
    flat = net.words.take(around.ravel(), axis=0).reshape(len(target), -1)
    inner = net.inner.reshape(-1, HIDDEN)
    hidden = flat @ inner
    hidden += net.shift
    _tanh(hidden)
    wide = _wide(hidden)
    error = _errors(wide @ net.classes, target // WITHIN)
    of_classes = wide.T @ error
    back = error @ net.classes.T
    own = np.empty((len(target), WITHIN), wide.dtype)
    for g, begin, end in parts:
        np.matmul(wide[begin:end], net.within[g], out=own[begin:end])
    _errors(own, target % WITHIN)
    of_within = np.zeros_like(net.within)
    from_within = np.empty_like(wide)
    for g, begin, end in parts:
        np.matmul(wide[begin:end].T, own[begin:end], out=of_within[g])
        np.matmul(own[begin:end], net.within[g].T, out=from_within[begin:end])
    back += from_within
    hidden *= hidden
    np.subtract(1, hidden, out=hidden)
    hidden *= back[:, :HIDDEN]
    of_seen = (hidden @ inner.T).reshape(-1, DIMENSIONS)
    # The places in the order of their words, so that each word's sum is one over a slice.
    ids = around.ravel().astype(np.uint16)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    of_words = np.zeros_like(net.words)
    of_words[ids[first]] = np.add.reduceat(of_seen.take(order, axis=0), first, axis=0)
    return [of_words, (flat.T @ hidden).reshape(net.inner.shape), hidden.sum(0), of_classes, of_within]


def train(net: Network, batches: Iterator[np.ndarray]) -> tuple[Network, int]:
    """A copy of the network after one pass over windows (rows: the ids around, then the word), and their number."""
    values = [getattr(net, f.name).copy() for f in fields(net)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    steps, rows = 0, 0
    for windows in batches:
        for at in range(0, len(windows), BATCH):
            part = windows[at : at + BATCH]
            steps, rows = steps + 1, rows + len(part)
            # The means of gradients and of their squares are a tenth of m and a hundredth of s, both too small at the start.
            spread = (0.01 / (1 - 0.99**steps)) ** 0.5
            step = STEP * 0.1 / (1 - 0.9**steps) / spread
            for v, m, s, g in zip(values, first, second, _gradient(Network(*values), part[:, :-1], part[:, -1])):
                m *= 0.9
                m += g
                s *= 0.99
                g *= g
                s += g
                np.sqrt(s, out=g)
                g += 1e-8 / spread
                np.divide(m, g, out=g)
                g *= step
                v -= g
    return Network(*values), rows


@dataclass
class Model:
    """hashes: the words of the vocabulary, sorted; ids: their numbers, by falling frequency.

    counts: word and n of every word of the documents; totals: for each bucket 1 + its distinct words + their counts.
    """

    hashes: np.ndarray
    ids: np.ndarray
    network: Network
    counts: DataFrame
    totals: np.ndarray


def _ids(hashes: np.ndarray, known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    bucket = (NAMED + (hashes & np.uint64(WITHIN - 1)).astype(np.int64)).astype(np.int64)
    if not len(known):
        return bucket
    at = np.searchsorted(known, hashes)
    at[at == len(known)] = 0
    return np.where(known[at] == hashes, ids[at], bucket)


def _windows(ids: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ids around the words at `at`; places outside a word's text hold OUTSIDE."""
    text = np.searchsorted(first, at, "right") - 1
    before, behind = at - first[text], first[text + 1] - at
    out = np.empty((2 * SIDE, len(at)), np.int64)
    for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        np.take(ids, at + d, out=out[k], mode="clip")
        out[k][before < -d if d < 0 else behind <= d] = OUTSIDE
    return out.T


def _residues(key: np.ndarray, first: np.ndarray, rate: int) -> np.ndarray:
    """The round of every word, by a hash of its text and its place in it, so it is the same in any partitioning."""
    counts = np.diff(first)
    place = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    return W.mix(np.repeat(key.view(np.uint64), counts) + W.mix(place.astype(np.uint64))) % np.uint64(rate)


def _counts(docs: DataFrame) -> DataFrame:
    """word (its hash) and n of every word of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            word, times = np.unique(W.split(batch.column("text"), W.ALNUM).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(times)], names=["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return cut(counts)


def _vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The NAMED most frequent words of all documents."""
    top = counts.orderBy(F.desc("n"), "word").limit(NAMED).collect()
    hashes = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], order.astype(np.int64)


def _totals(counts: DataFrame, known: np.ndarray) -> np.ndarray:
    """For each bucket 1 + the number of its distinct words + the sum of their counts, words of the vocabulary left out."""
    bucket = F.col("word").bitwiseAND(WITHIN - 1).cast("int").alias("bucket")
    out = np.ones(WITHIN)
    for r in counts.groupBy(bucket).agg((F.count(F.lit(1)) + F.sum("n")).alias("n")).collect():
        out[r["bucket"]] += r["n"]
    named = counts.sparkSession.createDataFrame([(int(h),) for h in known.view(np.int64)], "word bigint")
    for r in counts.join(F.broadcast(named), "word").select(bucket, (F.col("n") + 1).alias("n")).collect():
        out[r["bucket"]] -= r["n"]
    return out


def _encode(documents: DataFrame, known: np.ndarray, ids: np.ndarray, text: str, keep: list[str]) -> DataFrame:
    """One row for each document: key (of its text), row (the columns to keep), ids (of its words, two bytes each),
    rare and times (its distinct words outside the vocabulary and how often each occurs).

    Texts are split into words here; training, scoring and shares of rare words read the numbers.
    """
    kept = [F.struct(*[F.col(f"`{n}`") for n in keep]).alias("row")] if keep else []
    source = documents.select(F.xxhash64(F.col(text)).alias("key"), *kept, F.col(text).alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast((known, ids))
    schema = T.StructType(
        [
            *[f for f in source.schema.fields if f.name != "text"],
            T.StructField("ids", T.BinaryType()),
            T.StructField("rare", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            w = W.split(batch.column("text"), W.ALNUM)
            number = _ids(w.hashes, *sent.value)
            # Each outside word of a text once, with its number there. Only words in the last class can be outside.
            rare = np.flatnonzero(number >= NAMED)
            own = w.owner[rare]
            order = np.lexsort((w.hashes[rare], own))
            word, own = w.hashes[rare][order], own[order]
            new = np.ones(len(word), bool)
            new[1:] = (word[1:] != word[:-1]) | (own[1:] != own[:-1])
            begin = np.flatnonzero(new)
            times = np.diff(np.append(begin, len(word)))
            each = np.bincount(own[begin], minlength=batch.num_rows)
            values = number.astype("<u2").tobytes()
            coded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer((2 * w.first).astype(np.int64)), pa.py_buffer(values)]
            ).cast(pa.binary())
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in others],
                    coded,
                    W.lists(word[begin].view(np.int64), each, pa.int64()),
                    W.lists(times, each, pa.int32()),
                ],
                names=[*others, "ids", "rare", "times"],
            )

    return source.mapInArrow(encode, schema)


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of batches with about HELD words, or one longer text: the part, its words' ids, and where each text begins."""
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("ids").cast(pa.large_binary())
        raw = column.buffers()
        ends = np.frombuffer(raw[1], np.int64, len(column) + 1, column.offset * 8) // 2
        data = np.frombuffer(raw[2], "<u2", ends[-1]) if raw[2] is not None else np.zeros(0, "<u2")
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + HELD, "right")) - 1)
            yield batch.slice(at, upto - at), data[ends[at] : ends[upto]].astype(np.int64), ends[at : upto + 1] - ends[at]
            at = upto


def _average(copies: DataFrame) -> np.ndarray:
    """The mean of all copies (copy, block, rows, values), weighted by their rows."""

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame["rows"].to_numpy(np.float64)
        total = np.zeros(len(frame["data"].iloc[0]) // 4)
        for weight, data in zip(rows, frame["data"]):
            total += weight * np.frombuffer(data, np.float32)
        own = frame["copy"].iloc[0] // FAN
        data = (total / max(rows.sum(), 1.0)).astype(np.float32).tobytes()
        return pd.DataFrame({"copy": [own], "block": [frame["block"].iloc[0]], "rows": [int(rows.sum())], "data": [data]})

    most = copies.agg(F.max("copy")).first()[0]
    while most:
        parent = F.floor(F.col("copy") / FAN)
        copies = copies.groupBy("block", parent.alias("parent")).applyInPandas(
            mean, "copy bigint, block int, rows bigint, data binary"
        )
        most //= FAN
    parts = copies.orderBy("block").collect()
    return np.concatenate([np.frombuffer(r["data"], np.float32) for r in parts])


def _trained(encoded: DataFrame, rounds: int, rate: int) -> Network:
    """The network after the rounds. Round r trains on the places whose hash is r modulo `rate`."""
    net = Network.new()
    context = encoded.sparkSession.sparkContext

    def sample(batches: Iterator[pa.RecordBatch], residue: int) -> Iterator[np.ndarray]:
        for part, number, first in _numbers(batches):
            key = part.column("key").to_numpy(zero_copy_only=False)
            at = np.flatnonzero(_residues(key, first, rate) == residue)
            for k in range(0, len(at), 1 << 16):
                some = at[k : k + (1 << 16)]
                yield np.concatenate([_windows(number, first, some), number[some][:, None]], axis=1)

    for r in range(rounds):
        now = context.broadcast(net.flat())

        def copy(batches: Iterator[pa.RecordBatch], residue: int = r % rate) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trained, rows = train(Network.unflat(now.value), sample(batches, residue))
            if rows:
                flat = trained.flat()
                blocks = [flat[k : k + BLOCK].tobytes() for k in range(0, len(flat), BLOCK)]
                n = len(blocks)
                own = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own] * n), pa.array(range(n), pa.int32()), pa.array([rows] * n), pa.array(blocks, pa.binary())],
                    names=["copy", "block", "rows", "data"],
                )

        copies = cut(encoded.select("key", "ids").mapInArrow(copy, "copy bigint, block int, rows bigint, data binary"))
        if not copies.isEmpty():  # a tiny corpus may have no word in this residue
            net = Network.unflat(_average(copies))
        forget(copies)
    return net


def _fit(documents: DataFrame, text: str, rounds: int, rate: int, keep: list[str]) -> tuple[Model, DataFrame]:
    """The model, and the documents as `_encode` gives them, written to the shared folder."""
    counts = _counts(documents.select(F.col(text).alias("text")))
    known, ids = _vocabulary(counts)
    encoded = cut(_encode(documents, known, ids, text, keep))
    return Model(known, ids, _trained(encoded, rounds, rate), counts, _totals(counts, known)), encoded


def fit(documents: DataFrame, text: str = "text", rounds: int = ROUNDS, rate: int = RATE) -> Model:
    """Vocabulary and network from all documents. Without any word the network stays as it began.

    Round r trains on the places whose hash is r modulo `rate`, so `rate` rounds see every word. Texts are split into words
    twice: for the counts, and for the numbers of their words, which all rounds read.
    """
    model, encoded = _fit(documents, text, rounds, rate, [])
    forget(encoded)
    return model


def _shares(encoded: DataFrame, model: Model) -> DataFrame:
    """key (of a text) and share: the sum of the logarithms of its outside words' shares of their buckets."""
    words = encoded.select("key", F.posexplode(F.arrays_zip("rare", "times")).alias("at", "of"))
    # The first of a text counts the text.
    words = words.select("key", F.col("of.rare").alias("word"), F.col("of.times").alias("times"), (F.col("at") == 0).cast("int").alias("texts"))
    totals = F.array(*[F.lit(float(t)) for t in model.totals])
    total = F.get(totals, F.col("word").bitwiseAND(WITHIN - 1).cast("int"))
    # One more than the count, for words that the counts lack too.
    share = F.log((F.coalesce("n", F.lit(0)) + 1) / total)
    # Equal texts have one key: their sum is divided by their number.
    return (
        words.join(model.counts, "word", "left")
        .groupBy("key")
        .agg((F.sum(F.col("times") * share) / F.sum("texts")).alias("share"))
    )


def _scored(encoded: DataFrame, model: Model, rows: int) -> DataFrame:
    """The kept columns of encoded documents with n_words, log_prob and perplexity."""
    sent = encoded.sparkSession.sparkContext.broadcast(model.network.flat())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.unflat(sent.value)
        reach = net.reach()
        for part, number, first in _numbers(batches):
            total = np.zeros(len(number) + 1)
            for at in range(0, len(number), rows):
                some = np.arange(at, min(at + rows, len(number)))
                total[some + 1] = log_probabilities(net, reach, _windows(number, first, some), number[some])
            np.cumsum(total, out=total)
            value = total[first[1:]] - total[first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("row"), pa.array(np.diff(first)), pa.array(value)],
                names=["key", "row", "n_words", "log_prob"],
            )

    schema = T.StructType(
        [
            encoded.schema["key"],
            encoded.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("log_prob", T.DoubleType()),
        ]
    )
    scored = encoded.select("key", "row", "ids").mapInArrow(run, schema)
    total = F.col("log_prob") + F.coalesce("share", F.lit(0.0))
    per_word = F.when(F.col("n_words") > 0, F.exp(F.least(-total / F.col("n_words"), F.lit(700.0))))
    return scored.join(_shares(encoded, model), "key", "left").select(
        "row.*", "n_words", total.alias("log_prob"), per_word.alias("perplexity")
    )


def score(documents: DataFrame, model: Model, text: str = "text", rows: int = 1 << 12) -> DataFrame:
    """All columns of the documents with n_words, log_prob and perplexity.

    log_prob is the sum over all words of the logarithm of the probability that the network gives to the word from the SIDE words
    on either side. For a word outside the vocabulary that is its bucket's probability times (n + 1) / (1 + the bucket's distinct words
    + their counts), n being the word's count in the documents of the model, 0 for unseen ones. perplexity is exp(-log_prob / n_words). Texts without words, empty and null ones have no words, log_prob 0 and a null
    perplexity. Repeated rows get equal scores. Columns of these names are replaced. A task holds 2 MB of text, or one longer text, and
    the layers of `rows` words.
    """
    documents = documents.drop("n_words", "log_prob", "perplexity")
    return _scored(_encode(documents, model.hashes, model.ids, text, documents.columns), model, rows)


def fit_and_score(
    documents: DataFrame, keep: list[str], text: str = "text", rounds: int = ROUNDS, rate: int = RATE, rows: int = 1 << 12
) -> DataFrame:
    """`score` of the documents under the model of `fit` on the same documents, with the columns of `keep` (one at least).

    Texts are split into words twice in all; the numbers of their words lie in the shared folder as long as the result is read.
    """
    keep = [n for n in keep if n not in ("n_words", "log_prob", "perplexity")]
    model, encoded = _fit(documents, text, rounds, rate, keep)
    return _scored(encoded, model, rows)
