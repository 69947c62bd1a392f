"""Toxicity by subword bags: averaged n-gram embeddings under a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself (all hashed into a table), a text
the mean of its words, and a linear softmax over that gives the classes. Table and softmax are learned
together. A misspelled word never seen still holds n-grams that were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W

# Fitting takes about so many labelled rows, of texts up to so many characters.
ROWS = 4000
LONGEST = 10_000
BUCKETS_LOG2 = 20
# Text scored at a time.
SCORED_BYTES = 1 << 20
DIMENSIONS = 8
GRAMS = (3, 4, 5, 6)
EPOCHS = 8
RATE = 0.003
# N-grams met in fewer words of texts than this keep a zero vector: they would learn single texts by heart.
LEAST = 8
# Distinct words whose n-grams are taken at a time.
WORDS = 10_000
# N-grams, or words of texts, whose vectors are gathered at a time.
GATHERED = 1 << 17
# How many words of texts the prior on an n-gram's share of toxic texts counts for.
PRIOR = 10.0
# Texts are averages over hundreds of words; this brings their vectors to the size of a word's.
GAIN = 300.0


@dataclass(frozen=True)
class Model:
    """table: a vector for each n-gram bucket; weights, bias: the softmax over two classes."""

    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def logits(self) -> np.ndarray:
        """What each bucket adds to the logit of class 1 over class 0: the softmax is linear in the table."""
        return (self.table @ (self.weights[:, 1] - self.weights[:, 0]) * GAIN).astype(np.float32)

    def base(self) -> float:
        return float(self.bias[1] - self.bias[0])


def subwords(w: W.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words that start at w.starts[at], and how many each word has."""
    sizes = w.ends[at] - w.starts[at]
    place = np.repeat(w.starts[at] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    glued = np.full(sizes.sum() + len(at), 0x0A, np.uint8)
    glued[np.arange(sizes.sum()) + np.repeat(np.arange(len(at)), sizes)] = w.data[place]
    text = glued.tobytes().decode("utf-8", "replace").lower()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    stops = np.flatnonzero(points == 0x0A)  # a word holds no line feed
    # Each word with a border sign on either side: its line feed, and that of the word before.
    points = W.mix(np.concatenate([[np.uint64(0x0A)], points]))
    first, last = np.concatenate([[0], stops[:-1] + 1]), stops + 1  # places of the two borders
    word = np.repeat(np.arange(len(at)), last - first + 1)
    begin = np.repeat(first, last - first + 1)
    spot = np.arange(len(word)) - np.repeat(np.concatenate([[0], np.cumsum(last - first + 1)[:-1]]), last - first + 1)
    spot = spot + begin
    owners, buckets = [np.arange(len(at))], [w.hashes[at] >> np.uint64(64 - BUCKETS_LOG2)]
    for n in GRAMS:
        grams = W.ngrams(points, n)
        ok = spot + n - 1 <= last[word]
        owners.append(word[ok])
        buckets.append(grams[spot[ok]] >> np.uint64(64 - BUCKETS_LOG2))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(at))


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts lists that end at ends[1:] into stretches of about GATHERED entries, or one longer list."""
    at = 0
    while at < len(ends) - 1:
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + GATHERED, "right")) - 1)
        yield at, upto
        at = upto


def _means(
    table: np.ndarray, index: np.ndarray, counts: np.ndarray, weights: np.ndarray | None = None, by: str = "entry"
) -> np.ndarray:
    """Sums of table rows by list, in slices of bounded size; empty lists give zeros.

    Weights belong to the entries, to the lists, or to the rows of the table.
    """
    out = np.zeros((len(counts), *table.shape[1:]), np.float32)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for at, upto in _slices(ends):
        own = index[ends[at] : ends[upto]]
        rows = table[own]
        if weights is not None:
            if by == "entry":
                weight = weights[ends[at] : ends[upto]]
            else:
                weight = weights[own] if by == "row" else np.repeat(weights[at:upto], counts[at:upto])
            rows *= weight[:, None] if rows.ndim > 1 else weight
        some = np.flatnonzero(counts[at:upto])
        if len(some):
            out[at + some] = np.add.reduceat(rows, ends[at:upto][some] - ends[at], axis=0)
    return out


class _Adam:
    def __init__(self, value: np.ndarray):
        self.value, self.m, self.v, self.t = value, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, grad: np.ndarray, rate: float, floor: float = 1e-8) -> None:
        """floor: gradients well below it move a value less, in proportion."""
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        self.value -= rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + floor)


def _frequent_grams(w: W.Words, one: np.ndarray, per_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Buckets met in at least LEAST words of texts; by word and bucket: its number there; by word: how many, its share.

    Words are taken a few at a time, so that only what is kept is held.
    """
    cuts = range(0, len(one), WORDS)
    met = np.zeros(1 << BUCKETS_LOG2)
    for at in cuts:
        bucket, grams = subwords(w, one[at : at + WORDS])
        met += np.bincount(bucket, weights=np.repeat(per_word[at : at + WORDS], grams), minlength=len(met))
    often = met >= LEAST
    number = (np.cumsum(often) - 1).astype(np.int32)
    bucket_parts, kept_in, share = [np.zeros(0, np.int32)], np.zeros(len(one), np.int64), np.zeros(len(one), np.float32)
    for at in cuts:
        bucket, grams = subwords(w, one[at : at + WORDS])
        kept = often[bucket]
        bucket_parts.append(number[bucket[kept]])
        kept_in[at : at + WORDS] = np.bincount(np.repeat(np.arange(len(grams)), grams)[kept], minlength=len(grams))
        share[at : at + WORDS] = 1 / np.maximum(grams, 1)
    return np.flatnonzero(often), np.concatenate(bucket_parts), kept_in, share


def _turned(index: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of lists of numbers below n: by number the lists that hold it, in order, and how many."""
    key = index.astype(np.int64)
    key <<= 32
    ends = np.concatenate([[0], np.cumsum(counts)])
    for at, upto in _slices(ends):
        key[ends[at] : ends[upto]] |= np.repeat(np.arange(at, upto), counts[at:upto])
    key.sort()
    key &= 0xFFFFFFFF
    return key.astype(np.int32), _counted(index, counts, n, np.ones(len(counts))).astype(np.int64)


def _counted(index: np.ndarray, counts: np.ndarray, n: int, per: np.ndarray) -> np.ndarray:
    """For each number below n the sum of `per` over the lists that hold it."""
    out = np.zeros(n)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for at, upto in _slices(ends):
        out += np.bincount(index[ends[at] : ends[upto]], weights=np.repeat(per[at:upto], counts[at:upto]), minlength=n)
    return out


def train(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Table and softmax by full-batch Adam on the cross-entropy. Without rows, scores are one half."""
    rng = np.random.default_rng(seed)
    whole = np.zeros((1 << BUCKETS_LOG2, DIMENSIONS), np.float32)
    weights = _Adam(rng.uniform(-0.5, 0.5, (DIMENSIONS, 2)).astype(np.float32))
    bias = _Adam(np.zeros(2, np.float32))
    if not len(labels):
        return Model(whole, weights.value, bias.value)
    w = W.split(pa.array(texts, pa.string()), W.ALNUM)
    _, one, word = np.unique(w.hashes, return_index=True, return_inverse=True)
    pair, times = np.unique(w.owner * len(one) + word, return_counts=True)
    text_of, word_in = (x.astype(np.int32) for x in np.divmod(pair, max(len(one), 1)))
    n_pairs = len(pair)
    per_text = np.bincount(text_of, minlength=len(texts))
    part = (GAIN * times / np.maximum(w.counts[text_of], 1)).astype(np.float32)
    per_word = np.bincount(word_in, minlength=len(one))
    del pair, times, word
    # The frequent buckets of each word, and the words of each such bucket.
    used, bucket, grams, share = _frequent_grams(w, one, per_word)
    del w
    words_in, per_bucket = _turned(bucket, grams, len(used))
    # The first dimension starts from the smoothed log-odds of each n-gram, cubed so that the many weak ones
    # do not outweigh the few strong ones in an average; the other dimensions start near zero.
    seen = [np.bincount(word_in, weights=labels[text_of] == c, minlength=len(one)) for c in (0, 1)]
    odds = np.zeros(len(used))
    for sign, per in zip((-1, 1), seen):
        n = _counted(bucket, grams, len(used), per)
        odds += sign * np.log((n + PRIOR * per.sum() / n_pairs) / max(per.sum(), 1.0))
    start = rng.uniform(-0.01, 0.01, (len(used), DIMENSIONS)).astype(np.float32)
    start[:, 0] = (odds / 3) ** 3
    table = _Adam(start)
    weights.value[0] = (-0.5, 0.5)
    by_word = np.argsort(word_in, kind="stable")
    texts_with, part_in = text_of[by_word], part[by_word]
    del by_word, text_of
    goal = np.eye(2, dtype=np.float32)[labels]
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        bags = _means(_means(table.value, bucket, grams, share, "list"), word_in, per_text, part)
        scores = bags @ weights.value + bias.value
        scores = np.exp(scores - scores.max(1, keepdims=True))
        error = (scores / scores.sum(1, keepdims=True) - goal) / len(labels)
        back = error @ weights.value.T
        to_words = _means(back, texts_with, per_word, part_in)
        grad = _means(to_words, words_in, per_bucket, share, "row")
        weights.step(bags.T @ error, 10 * rate)
        bias.step(error.sum(0), 100 * rate)
        table.step(grad, rate, float(np.sqrt((grad * grad).mean())))
    bags = _means(_means(table.value, bucket, grams, share, "list"), word_in, per_text, part)
    scale, shift = _calibrated(bags @ (weights.value[:, 1] - weights.value[:, 0]), labels)
    whole[used] = table.value
    return Model(whole, weights.value * np.float32(scale), np.array([0, shift], np.float32))


def _calibrated(values: np.ndarray, labels: np.ndarray, ridge: float = 1e-4) -> tuple[float, float]:
    """Scale and shift of the softmax that fit the labels best, both classes weighing the same, by Newton steps."""
    weight = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    x = np.stack([values / max(values.std(), 1e-6), np.ones(len(values))], 1).astype(np.float64)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + ridge * at
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at -= step / max(1.0, np.abs(step).max())
    return max(float(at[0]), 0.0) / max(float(values.std()), 1e-6), float(at[1])


def fit(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = ROWS
) -> Model:
    """A model from a bounded sample: about `rows` labelled texts of at most LONGEST characters.

    Rows are chosen by a hash of their id, the same ones in any partitioning. Null labels and ids teach nothing.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1)
    )
    n = known.count()
    most = int(min(1, rows / max(n, 1)) * (1 << 30))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < most).distinct()
    texts = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.length("text") <= LONGEST)
    # The chosen ids number about `rows`, whatever the input.
    sample = texts.join(F.broadcast(chosen), "id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([sample_schema, *frames]).sort_values(["id", "label", "text"], kind="stable")
        model = train(rows["text"].tolist(), rows["label"].to_numpy(np.int64))
        used = np.flatnonzero(model.table.any(axis=1))
        parts = [used, model.table[used], model.weights, model.bias]
        yield pd.DataFrame({"part": range(4), "data": [p.tobytes() for p in parts]})
        del rows, model, used, parts
        W.give_back()

    # One task trains on the bounded sample: its arrays are several times the sample, and the driver needs none of them.
    sample_schema = pd.DataFrame({"id": [], "text": [], "label": []})
    found = {r["part"]: bytes(r["data"]) for r in sample.repartition(1).mapInPandas(run, "part int, data binary").collect()}
    table = np.zeros((1 << BUCKETS_LOG2, DIMENSIONS), np.float32)
    if not found:  # a task without rows
        return train([], np.zeros(0, np.int64))
    table[np.frombuffer(found[0], np.int64)] = np.frombuffer(found[1], np.float32).reshape(-1, DIMENSIONS)
    weights = np.frombuffer(found[2], np.float32).reshape(DIMENSIONS, 2)
    return Model(table, weights, np.frombuffer(found[3], np.float32))


def _of_words(bucket_logit: np.ndarray, w: W.Words, one: np.ndarray) -> np.ndarray:
    """The mean over the n-grams of each word that starts at w.starts[one]; words are taken a few at a time."""
    parts = []
    for at in range(0, len(one), WORDS):
        bucket, grams = subwords(w, one[at : at + WORDS])
        parts.append(_means(bucket_logit, bucket, grams) / np.maximum(grams, 1))
    return np.concatenate(parts)


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of the documents with toxic_score (0 to 1) and toxic_pred (1 from one half on).

    Every word of a text counts, however long it is. Null and empty texts, and texts without words, have the
    score of the bias alone. Columns of these two names are replaced. A task scores 1 MB of
    text at a time, or one longer text, with 4 MB of model, and the n-grams of WORDS of its distinct words.
    """
    documents = documents.drop("toxic_score", "toxic_pred")
    names = documents.columns
    sent = documents.sparkSession.sparkContext.broadcast((model.logits(), model.base()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_logit, base = sent.value
        for batch in W.slices(batches, text, SCORED_BYTES):
            w = W.split(batch.column(text), W.ALNUM)
            logit = np.full(batch.num_rows, base)
            if len(w.hashes):
                _, one, word = np.unique(w.hashes, return_index=True, return_inverse=True)
                sums = np.concatenate([[0.0], np.cumsum(_of_words(bucket_logit, w, one)[word], dtype=np.float64)])
                logit += (sums[w.first[1:]] - sums[w.first[:-1]]) / np.maximum(w.counts, 1)
            value = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                names=[*names, "toxic_score", "toxic_pred"],
            )

    schema = T.StructType(
        [
            *documents.schema.fields,
            T.StructField("toxic_score", T.DoubleType()),
            T.StructField("toxic_pred", T.IntegerType()),
        ]
    )
    return documents.mapInArrow(run, schema)
