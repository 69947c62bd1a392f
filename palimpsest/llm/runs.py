"""Periodic runs of words: where a text repeats itself at once, several times over.

A run is a stretch of words in which words q apart are the same, q being the smallest such number, that no
neighbouring word extends. Its roots are Lyndon words under one of the two orders of the words, and the longest
Lyndon word at the start of such a root is that root. So both Lyndon arrays hold every run's period, and the longest
common extensions of a root and its repetition, to either side, give the run.

The Lyndon array comes from the grouping phase of Baier's suffix sorter alone: suffixes lie in groups by their first
words, and groups are taken from the highest to the lowest. Taking a group lengthens the prefix of each nearest lower suffix
before its members by their own prefix, as often as members follow it, and moves that suffix into a group just above its own.
When a group is taken, the length of its prefix is the longest Lyndon word of its members. No suffix is sorted.

Words are compared by their numbers in a dictionary, not by hashes. Hashes only leave out what cannot be a run, and find the
extensions, which are then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palimpsest.llm import words as W

SHORTEST = 24
TIMES = 3
BATCH_BYTES = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def lyndon(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place, for ranks 0 to k - 1 that all occur."""
    n = len(ranks)
    groups: list[list[int]] = [[] for _ in range(max(ranks, default=-1) + 1)]
    for i, r in enumerate(ranks):
        groups[r].append(i)
    top = len(groups) - 1
    live = [len(g) for g in groups]
    size = [1] * len(groups)
    below, above = list(range(-1, top)), list(range(1, top + 2))
    group_of = list(ranks)
    # Places whose group has not been taken, as a list linked to both sides; -1 and n are its ends.
    left, right = list(range(-1, n)), list(range(1, n + 2))
    out = [0] * n

    def move(places: list[int], h: int, longer: int) -> None:
        """Lengthens the prefix of some members of a group: all of them, or into a group just above it."""
        if live[h] == len(places):
            size[h] += longer
            return
        new = len(groups)
        live[h] -= len(places)
        groups.append(places)
        live.append(len(places))
        size.append(size[h] + longer)
        below.append(h)
        above.append(above[h])
        below[above[h]] = new
        above[h] = new
        for p in places:
            group_of[p] = new

    taken = top  # nothing is ever put above the highest group
    while taken >= 0:
        length = size[taken]
        if live[taken] == 1:  # the most frequent case
            i = next(x for x in groups[taken] if group_of[x] == taken)
            p, q = left[i], right[i]
            out[i] = length
            left[q] = p
            if p >= 0:
                right[p] = q
                move([p], group_of[p], length)
        else:
            parents: list[int] = []
            follow: list[int] = []
            last = -1
            for i in groups[taken]:
                if group_of[i] != taken:
                    continue
                # Members go in ascending order, so what is left of one is not a member.
                p, q = left[i], right[i]
                out[i] = length
                left[q] = p
                if p < 0:
                    continue
                right[p] = q
                if p == last:
                    follow[-1] += 1
                else:
                    parents.append(p)
                    follow.append(1)
                    last = p
            # Those followed by more members go first, so that they end up higher.
            by_count: dict[int, dict[int, list[int]]] = {}
            for p, k in zip(parents, follow):
                by_count.setdefault(k, {}).setdefault(group_of[p], []).append(p)
            for k in sorted(by_count, reverse=True):
                for h, places in by_count[k].items():
                    move(places, h, k * length)
        taken = below[taken]
    return out


def _longest(total: np.ndarray, powers: np.ndarray, i: np.ndarray, q: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
    """How far words at i and at i + q are the same by their hashes, ahead or back, up to `most`."""
    low, high = np.zeros(len(i), np.int64), most.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        a, b = (i, i + mid) if ahead else (i - mid, i)
        same = (total[b] - total[a]) * powers[q] == total[b + q] - total[a + q]
        low = np.where(same, mid, low)
        high = np.where(same, high, mid - 1)
    return low


def _exact(word: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch around i in which words q apart are the same, word by word."""
    same = word[:-q] == word[q:]
    ahead = np.flatnonzero(~same[i:])
    back = np.flatnonzero(~same[:i])
    return (int(back[-1]) + 1 if len(back) else 0), (i + int(ahead[0]) if len(ahead) else len(same)) + q


def runs_of(word: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `shortest` words and `times` periods (2 or more), by start and period."""
    n = len(word)
    if n < max(shortest, times):
        return []
    _, rank = np.unique(word, return_inverse=True)
    # The first root in a run begins within its first period, so at least so many words at it recur a period on.
    sure = max(1, min(shortest - 2 * (shortest // times) + 1, shortest // times + 2)) if times > 2 else 1
    value = W.mix(rank.astype(np.uint64) + np.uint64(1))
    powers = np.full(n + 1, _FACTOR)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    total = np.concatenate([[np.uint64(0)], np.cumsum(value * powers[:n])])
    grams = W.ngrams(value, sure)
    found = []
    for order in (rank, rank.max() - rank):
        period = np.array(lyndon(order.tolist()), np.int64)
        at = np.flatnonzero(np.arange(n) + period < len(grams))
        at = at[grams[at] == grams[at + period[at]]]
        q = period[at]
        ahead = _longest(total, powers, at, q, n - at - q, True)
        back = _longest(total, powers, at, q, at.copy(), False)
        start, stop = at - back, at + q + ahead
        ok = stop - start >= np.maximum(shortest, times * q)
        # Roots of one run give the same stretch.
        found.append(np.stack([start[ok], stop[ok], q[ok], at[ok]], 1))
    every = np.concatenate(found)
    stretches, which = np.unique(every[:, :3], axis=0, return_inverse=True)
    out = set()
    for k, (start, stop, q) in enumerate(stretches.tolist()):
        if (word[start : stop - q] == word[start + q : stop]).all():
            out.add((start, stop - start, q))
            continue
        for at in every[which.ravel() == k, 3].tolist():  # two hashes met
            start, stop = _exact(word, at, q)
            if stop - start >= max(shortest, times * q):
                out.add((start, stop - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _may_repeat(code: np.ndarray, owner: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Which texts hold some `size` words twice."""
    out = np.zeros(texts, bool)
    grams = W.ngrams(W.mix(code.astype(np.uint64) + np.uint64(1)), size)
    ok = W.within(owner, size)
    owner = owner[: len(ok)][ok]
    keyed = W.mix(grams[ok] + owner.astype(np.uint64) * _FACTOR)
    order = np.argsort(keyed)
    keyed, owner = keyed[order], owner[order]
    out[owner[1:][keyed[1:] == keyed[:-1]]] = True
    return out


def _codes(w: W.Words, keep: np.ndarray) -> np.ndarray:
    """The number of each word in a dictionary of the batch; `keep`: the bytes of words."""
    flat = np.ascontiguousarray(w.data[keep])
    stops = np.concatenate([[0], np.cumsum(w.ends - w.starts)]).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_binary(), len(w.starts), [None, pa.py_buffer(stops), pa.py_buffer(flat)])
    return texts.dictionary_encode().indices.to_numpy().astype(np.int64)


def split(texts: pa.Array) -> tuple[W.Words, np.ndarray]:
    """Words without hashes, and which bytes belong to words."""
    data, offsets = W.buffers(texts)
    keep = W.SPACED[data]
    starts, ends = W.borders(data, offsets, W.SPACED) if len(data) else (np.zeros(0, np.int64),) * 2
    return W.Words(np.zeros(0, np.uint64), starts, ends, np.searchsorted(starts, offsets), data), keep


def find(texts: pa.Array, shortest: int = SHORTEST, times: int = TIMES) -> tuple[np.ndarray, list[list], pa.Array]:
    """Words of each text, its runs, and the text without what runs repeat."""
    w, keep = split(texts)
    counts = w.counts
    runs: list[list] = [[] for _ in counts]
    data, keep = w.data.copy(), keep.copy()
    stays = np.ones(len(w.starts), bool)
    if len(w.starts):
        code = _codes(w, keep)
        # The words of a run but its last period all recur, so these many in a row occur twice.
        twice = shortest - shortest // times
        for i in np.flatnonzero(_may_repeat(code, w.owner, len(counts), twice)).tolist():
            low, high = w.first[i], w.first[i + 1]
            runs[i] = runs_of(code[low:high], shortest, times)
            for start, length, period in runs[i]:
                stays[low + start + period : low + start + length] = False
        if not stays.all():
            gone = np.zeros(len(keep) + 1, np.int8)
            gone[w.starts[~stays]] += 1
            gone[w.ends[~stays]] -= 1
            keep &= np.cumsum(gone[:-1], dtype=np.int8) == 0
        # One space behind every word that stays, in place of the first white space there, but for a text's last.
        kept = np.flatnonzero(stays)
        follows = np.append(w.owner[kept][1:] == w.owner[kept][:-1], False)
        data[w.ends[kept[follows]]] = 0x20
        keep[w.ends[kept[follows]]] = True
    _, offsets = W.buffers(texts)
    stops = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
    parts = [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(data[keep]))]
    return counts, runs, pa.Array.from_buffers(pa.large_string(), len(counts), parts).cast(pa.string())


def find_runs(documents: DataFrame, text: str = "text", shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """All columns of the documents with n_words, runs and collapsed.

    runs: start (word number from 0), length and period of every run of at least `shortest` words and `times` periods (3 or
    more), by start and period. collapsed: the words joined by one space, without those that some run contains after
    its first period. A null or empty text has no words, no runs and an empty collapsed text. Columns of these three
    names are replaced; rows are taken one by one, so repeated ones change nothing. Every text is searched whole: a
    task holds about 1 MB of text at a time, or one longer text, and about 500 bytes for each word of the text it searches.
    """
    if times < 3:
        raise ValueError("runs of at least three periods")
    documents = documents.drop("n_words", "runs", "collapsed")
    names = documents.columns
    fields = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, text, BATCH_BYTES):
            counts, runs, collapsed = find(batch.column(text), shortest, times)
            flat = np.array([x for some in runs for x in some], np.int64).reshape(-1, 3)
            values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=[pa.field(*f) for f in fields])
            stops = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(stops), values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts), lists, collapsed], names=[*names, "n_words", "runs", "collapsed"]
            )

    one = T.StructType([T.StructField(name, T.LongType()) for name, _ in fields])
    added = [("n_words", T.LongType()), ("runs", T.ArrayType(one)), ("collapsed", T.StringType())]
    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, *[T.StructField(*x) for x in added]]))
