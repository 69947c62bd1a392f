"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy.

A batch of texts stays one UTF-8 buffer. Word borders come from a table over bytes, so the classes
of bytes decide what a word is; bytes from 0x80 on, all parts of non-ASCII characters, belong to words
in both tables below. Hashes are polynomial sums over the bytes of a word, taken from one running
sum per chunk, and mixed afterwards.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
BATCH_BYTES = 2 << 20

_ALL = np.arange(256)
FOLD = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)
# Letters, digits and every non-ASCII character, after A-Z are lower-cased.
ALNUM = (_ALL >= 0x80) | ((FOLD >= 0x61) & (FOLD <= 0x7A)) | ((_ALL >= 0x30) & (_ALL <= 0x39))
# Everything but the six white-space characters of ASCII.
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_LENGTH = np.uint64(0xA24BAED4963EE407)


@cache
def _values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE)[FOLD]


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    base = int(_BASE) | 1
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, np.uint64(x))
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; null is empty."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds about `most` bytes of text, or one longer text.

    Memory of Arrow is the system's from here on: a task gives back what it no longer needs.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can: workers wait for their next task with what they hold."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """hashes, starts and ends by word (bytes of the buffer); first by text: its words are first[i]:first[i+1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def borders(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; a word never runs over the border of two texts."""
    inside = table[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    start[cuts] |= inside[cuts]
    end[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _hashed(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words in at most CHUNK bytes."""
    up, down = _powers(CHUNK + 1)
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_values()[part] * up[: len(part)], out=total[1:])
    sums = (total[ends] - total[starts]) * down[starts]
    return mix(sums + (ends - starts).astype(np.uint64) * _LENGTH)


def split(texts: pa.Array, table: np.ndarray) -> Words:
    """All words of the texts, in order."""
    data, offsets = buffers(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none.view(np.uint64), none, none, np.zeros(len(offsets), np.int64), data)
    starts, ends = borders(data, offsets, table)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # As many words as lie within a chunk.
        low = starts[at]
        upto = int(np.searchsorted(ends, low + CHUNK, "right"))
        if upto > at:
            part = data[low : ends[upto - 1]]
            hashes[at:upto] = _hashed(part, starts[at:upto] - low, ends[at:upto] - low)
            at = upto
        else:  # a longer word, in pieces
            whole = np.zeros(1, np.uint64)
            for piece in range(low, ends[at], CHUNK):
                part = data[piece : min(piece + CHUNK, ends[at])]
                whole = mix(whole * _STEP + _hashed(part, np.array([0]), np.array([len(part)])))
            hashes[at] = whole[0]
            at += 1
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), data)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each word on; the last n - 1 words start none."""
    size = max(0, len(hashes) - n + 1)
    out = hashes[:size].copy()
    for k in range(1, n):
        out *= _STEP
        out += hashes[k : k + size]
    return mix(out + np.uint64(n))


def within(owner: np.ndarray, n: int) -> np.ndarray:
    """Which words are the first of n words of one text."""
    size = max(0, len(owner) - n + 1)
    return owner[:size] == owner[n - 1 : n - 1 + size]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its values in a row and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
