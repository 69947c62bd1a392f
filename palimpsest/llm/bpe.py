"""Byte-level BPE with a vectorised pre-tokeniser.

The pattern of the public rank files splits a text into runs of letters, of numbers, of other signs (each
with one space before it), English endings after an apostrophe, and white space. No regular expression is run:
every code point becomes a symbol (its class, and whether white space or an ending follows), every symbol a
transition function over the eight states of the splitter, and an associative scan composes the functions
of all code points of a batch. Functions are numbers, and their products a table, since the symbols generate few
different ones. The first code point of a text is a constant function, so nothing crosses texts.

The slices between borders are merged by rank, each distinct one once while it is cached, and those of one length side by
side. Where each token's bytes end is kept beside the ids, so decoding places the bytes of all tokens at once.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palimpsest.llm import words as W

# Text split at a time.
BATCH_BYTES = 1 << 20
# Slices and their ids kept by one task.
CACHED_BYTES = 16 << 20
# Slices up to so many bytes are merged side by side and cached, longer ones by themselves.
SIDE_BY_SIDE = 48
# The rank of a pair that makes no token.
APART = 1 << 40

# Symbols of code points: white space that more white space or the end follows, other white space, a space there.
LETTER, NUMBER, SIGN, TWO, THREE, WHITE, LAST_WHITE, LAST_SPACE = range(8)
# States: within letters, numbers, signs; after white space; after a space that belongs to what follows; within an
# ending with two letters or one to come; after an ending.
IN_LETTERS, IN_NUMBERS, IN_SIGNS, AFTER_WHITE, JOINED, TWO_LEFT, ONE_LEFT, ENDED = range(8)
# White space outside the ASCII range, and the endings.
WIDE_WHITE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = "s", "t", "m", "d", "re", "ve", "ll"


@cache
def classes() -> np.ndarray:
    """LETTER, NUMBER, SIGN or WHITE for every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], SIGN) for c in range(0x110000)], np.uint8)
    out[[*range(0x09, 0x0E), 0x20, *WIDE_WHITE]] = WHITE
    return out


def _step(state: int, symbol: int) -> int:
    if symbol == LETTER:
        return {TWO_LEFT: ONE_LEFT, ONE_LEFT: ENDED}.get(state, IN_LETTERS)
    if symbol in (TWO, THREE):  # an apostrophe before an ending counts only where a slice starts
        return IN_SIGNS if state in (IN_SIGNS, JOINED) else ONE_LEFT if symbol == TWO else TWO_LEFT
    return {NUMBER: IN_NUMBERS, SIGN: IN_SIGNS, WHITE: AFTER_WHITE, LAST_WHITE: AFTER_WHITE, LAST_SPACE: JOINED}[symbol]


def _starts(state: int, symbol: int) -> bool:
    """Does a slice start at a symbol read in a state?"""
    if symbol == LETTER:
        return state not in (IN_LETTERS, JOINED, TWO_LEFT, ONE_LEFT)
    if symbol == NUMBER:
        return state not in (IN_NUMBERS, JOINED)
    if symbol == WHITE:
        return state != AFTER_WHITE
    return symbol in (LAST_WHITE, LAST_SPACE) or state not in (IN_SIGNS, JOINED)


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Products of functions (rows first), what each makes of every state, the functions of symbols (those that
    begin a text from 8 on), and the number of the identity."""
    steps = [tuple(_step(state, x) for state in range(8)) for x in range(8)]
    first = [(f[AFTER_WHITE],) * 8 for f in steps]  # any state from which a slice starts
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *steps, *first]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in steps + first:
            if (h := tuple(g[x] for x in f)) not in known:
                known[h] = len(known)
                todo.append(h)
    functions = list(known)
    table = np.array([[known[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint16)
    return table, np.array(functions, np.uint8), np.array([known[f] for f in steps + first], np.uint16), 0


@cache
def _start_table() -> np.ndarray:
    """By state and symbol; the symbols that begin a text always start a slice."""
    return np.array([[_starts(state, x) for x in range(8)] + [True] * 8 for state in range(8)])


def scan(functions: np.ndarray, rows: int = 256) -> np.ndarray:
    """The product of all functions up to each place: within rows side by side, then over the rows' totals."""
    table, _, _, identity = _monoid()
    n, flat = len(functions), table.ravel()
    size = np.uint32(len(table))
    if n <= 2 * rows:
        out, reach = functions.copy(), 1
        while reach < n:
            out[reach:] = flat[out[:-reach] * size + out[reach:]]
            reach *= 2
        return out
    width = -(-n // rows)
    grid = np.full(rows * width, identity, np.uint16)
    grid[:n] = functions
    grid = grid.reshape(width, rows).T.copy()  # column j holds places j * rows and on
    for k in range(1, rows):
        grid[k] = flat[grid[k - 1] * size + grid[k]]
    before = scan(grid[-1], rows)[:-1]
    grid[:, 1:] = flat[before * size + grid[:, 1:]]
    return grid.T.ravel()[:n]


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of each code point, plus 8 where a text begins (`first`: where, without empty texts)."""
    n = len(points)
    out = classes()[points]
    begins = np.zeros(n + 3, bool)
    begins[first] = True
    begins[n:] = True
    white = out == WHITE
    after = np.append(white[1:], True) | begins[1 : n + 1]
    last = white & ~after
    out[last] = np.where(points[last] == 0x20, LAST_SPACE, LAST_WHITE)
    at = np.flatnonzero((points == 0x27) & ~begins[1 : n + 1])
    ahead = np.append(points, [0, 0])
    for ending in ENDINGS:
        hit = at[ahead[at + 1] == ord(ending[0])]
        if len(ending) == 2:
            hit = hit[(ahead[hit + 2] == ord(ending[1])) & ~begins[hit + 2]]
        out[hit] = TWO if len(ending) == 1 else THREE
    out[first] += 8
    return out


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes at which slices start, for texts that lie in one UTF-8 buffer; every text is covered by its slices."""
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    lengths = np.diff(offsets)
    symbol = symbols(points, np.searchsorted(heads, offsets[:-1][lengths > 0]))
    _, functions, of_symbol, _ = _monoid()
    state = functions[scan(of_symbol[symbol]), 0]
    before = np.concatenate([state[:1], state[:-1]])
    return heads[_start_table()[before, symbol]]


class Ranks:
    """The ranks of a file, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.of = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = [b""] * (max(self.of.values(), default=-1) + 1)
        for token, rank in self.of.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([self.of[bytes([b])] for b in range(256)], np.int64)
        # Every way to put a token together from two: pairs of ids in order, and what they make.
        pairs = [
            (self.of[token[:k]] << 32 | self.of[token[k:]], rank)
            for token, rank in self.of.items()
            for k in range(1, len(token))
            if token[:k] in self.of and token[k:] in self.of
        ]
        pairs.sort()
        self.pairs = np.array([p for p, _ in pairs] or [-1], np.int64)
        self.made = np.array([m for _, m in pairs] or [APART], np.int64)
        self.cache: dict[bytes, bytes] = {}
        self.cached = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a slice: the pair of lowest rank merges first, of equal ones the left one."""
        of, n = self.of, len(piece)
        if (whole := of.get(piece)) is not None:
            return [whole]
        # A part is known by its first byte: where it ends (0: merged into the part before it), and the part before.
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := of.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue
            end[i], end[j], before[k] = k, 0, i
            if k < n and (rank := of.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (rank, i, k, end[k]))
            left = before[i]
            if left >= 0 and (rank := of.get(piece[left:k])) is not None:
                heapq.heappush(heap, (rank, left, i, k))
        out, i = [], 0
        while i < n:
            out.append(of[piece[i : end[i]]])
            i = end[i]
        return out

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs of ids make; APART where they make no token."""
        wanted = left << 32 | right
        at = np.searchsorted(self.pairs, wanted)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == wanted, self.made[at], APART)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (as the bytes of a uint32 array) of slices of one length, all of them merged one pair at a time side by side."""
        raw = np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)
        ids = self.single[raw]
        ranks = self.joined(ids[:, :-1], ids[:, 1:])
        row, out = np.arange(len(pieces)), [b""] * len(pieces)
        while len(row):
            if ids.shape[1] > 1:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(row)), at]
            else:
                best = np.full(len(row), APART)
            done = best == APART
            if done.any():
                size = 4 * ids.shape[1]
                flat = ids[done].astype(np.uint32).tobytes()
                for k, i in enumerate(row[done].tolist()):
                    out[i] = flat[k * size : (k + 1) * size]
                if done.all():
                    break
                row, ids, ranks, at, best = (x[~done] for x in (row, ids, ranks, at, best))
            # The pair becomes one id, and all behind it move up.
            here, width = np.arange(len(row)), ids.shape[1] - 1
            ids[here, at] = best
            ids = np.take_along_axis(ids, np.arange(width) + (np.arange(width) > at[:, None]), 1)
            ranks = np.take_along_axis(ranks, np.arange(width - 1) + (np.arange(width - 1) >= at[:, None]), 1)
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self.joined(ids[some, at[some] - 1], ids[some, at[some]])
            some = np.flatnonzero(at < width - 1)
            ranks[some, at[some]] = self.joined(ids[some, at[some]], ids[some, at[some] + 1])
        return out

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct slices, each as the bytes of a uint32 array; what is not cached is merged together."""
        found = [self.cache.get(p) for p in pieces]
        by_length: dict[int, list[int]] = {}
        for i, f in enumerate(found):
            if f is None:
                whole = self.of.get(pieces[i])
                if whole is not None:
                    found[i] = np.uint32(whole).tobytes()
                elif len(pieces[i]) > SIDE_BY_SIDE:
                    found[i] = np.array(self.merge(pieces[i]), np.uint32).tobytes()
                else:
                    by_length.setdefault(len(pieces[i]), []).append(i)
        for some in by_length.values():
            for i, f in zip(some, self.merge_all([pieces[i] for i in some])):
                found[i] = f
            self.cached += sum(150 + len(pieces[i]) + len(found[i]) for i in some)
            if self.cached > CACHED_BYTES:
                self.cache.clear()
                self.cached = 0
            self.cache.update((pieces[i], found[i]) for i in some)
        return found


def encode(ranks: Ranks, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in a row, where each token's bytes end in its text, and how many tokens each text has."""
    data, offsets = W.buffers(texts)
    starts = borders(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint32), none, np.zeros(len(texts), np.int64)
    stops = np.append(starts, len(data))
    slices = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = slices.dictionary_encode()
    found = ranks.ids(coded.dictionary.to_pylist())
    sizes = np.array([len(f) // 4 for f in found], np.int64)
    flat = np.frombuffer(b"".join(found), np.uint32)
    code = coded.indices.to_numpy()
    per_slice = sizes[code]
    begin = np.cumsum(per_slice) - per_slice
    ids = flat[np.repeat((np.cumsum(sizes) - sizes)[code] - begin, per_slice) + np.arange(per_slice.sum())]
    counts = np.diff(np.append(begin, len(ids))[np.searchsorted(starts, offsets)])
    ends = np.cumsum(ranks.lengths[ids]) - np.repeat(offsets[:-1], counts)
    return ids, ends, counts


def decode(ranks: Ranks, ids: np.ndarray, ends: np.ndarray | None = None) -> bytes:
    """The bytes of ids, each placed before its end (of their lengths in a row where no ends were kept)."""
    if not len(ids):
        return b""
    if ids.max() >= len(ranks.lengths):
        raise ValueError("an id that the rank file does not hold")
    lengths = ranks.lengths[ids]
    ends = np.cumsum(lengths) if ends is None else ends
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros(int(ends[-1]), np.uint8)
    out[np.repeat(ends - lengths, lengths) + inside] = ranks.bytes[np.repeat(ranks.starts[ids], lengths) + inside]
    return out.tobytes()


@cache
def _ranks(path: str) -> Ranks:
    return Ranks(path)


def packed(values: np.ndarray, counts: np.ndarray, nulls: np.ndarray) -> pa.Array:
    """Numbers in a row as one binary value for each list."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    valid = pa.array(~nulls).buffers()[1] if nulls.any() else None
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [valid, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]
    ).cast(pa.binary())


def encode_column(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of the documents with tokens, token_ends (binary) and n_tokens.

    tokens: the ids as unsigned 32-bit little-endian numbers, as training shards hold them. token_ends: where the
    bytes of each token end in the text, as unsigned 64-bit numbers. A null text has null for both and no tokens, an empty one has
    none. Columns of these three names are replaced; rows are taken one by one, so repeated ones change nothing. Every text is
    encoded whole: a task splits about 1 MB of text at a time, or one longer text. `path` names a rank file that is
    installed on every machine.
    """
    documents = documents.drop("tokens", "token_ends", "n_tokens")
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path)
        for batch in W.slices(batches, text, BATCH_BYTES):
            column = batch.column(text)
            ids, ends, counts = encode(ranks, column)
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, packed(ids, counts, nulls), packed(ends.astype(np.uint64), counts, nulls), pa.array(counts)],
                names=[*names, "tokens", "token_ends", "n_tokens"],
            )

    added = [("tokens", T.BinaryType()), ("token_ends", T.BinaryType()), ("n_tokens", T.LongType())]
    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, *[T.StructField(*x) for x in added]]))


def decode_column(
    encoded: DataFrame, path: str, tokens: str = "tokens", ends: str | None = "token_ends", out: str = "decoded"
) -> DataFrame:
    """All columns with the bytes of the tokens; null for null. A column named `out` is replaced.

    `ends` is the column of kept ends; None where there is none. An id the rank file does not hold fails.
    """
    encoded = encoded.drop(out)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                kept = part.column(ends) if ends else [None] * part.num_rows
                found = []
                for value, stop in zip(part.column(tokens), kept):
                    if not value.is_valid:
                        found.append(None)
                        continue
                    ids = np.frombuffer(value.as_buffer(), np.uint32)
                    placed = None if stop is None or not stop.is_valid else np.frombuffer(stop.as_buffer(), np.int64)
                    found.append(decode(ranks, ids, placed))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*names, out])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())]))
