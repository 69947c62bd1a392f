"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

Words of equal length advance together: at every position all pieces that may end there are looked up
at once (substring hashes in sorted piece keys), and the maximum over them stores a back pointer for each
word. Two kinds of model are read from a `.model` file:

- unigram: a path's value is the sum of its pieces' scores, and the best path wins;
- BPE: the pieces of a prefix are the first pieces of the word, so the lattice has one path that merging
  would leave: every step must be a pair of pieces that merging by score keeps apart. Among the steps that
  end at a position at most one is allowed, and the maximum is taken over those.

Characters no piece covers become byte pieces (or the unknown piece, where the model has no bytes).
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W

SPACE = "▁"
NORMAL, UNKNOWN, BYTE, UNUSED, USER = 1, 2, 6, 5, 4
UNIGRAM, BPE = 1, 2
# Text searched at a time, bytes of words kept with their pieces by one task, and places for pairs of pieces with whether they stay apart.
BATCH_BYTES = 4 << 20
CACHED_BYTES = 16 << 20
CACHED_PAIRS_LOG2 = 20
# From so many new pairs on they are merged side by side.
TOGETHER = 64
# A batch of words of one length is searched in parts of so many characters times the longest piece.
CELLS = 1 << 21
# Longer words of a BPE model are searched in stretches of so many characters that overlap by so many.
STRETCH, OVERLAP = 512, 64
# The code that stands before the first piece of a word, and the rank of a pair that does not merge.
NONE = 1 << 30
NEVER = 1 << 40

_POW = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """The pieces of a model file and what the search needs of them."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    bpe: bool
    dummy_prefix: bool
    strip: bool
    keys: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self):
        usable = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER)]
        keys = np.array([_hash_of(self.pieces[i]) for i in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable, np.int64)[order]
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.longest = max((len(self.pieces[i]) for i in usable), default=1)
        self.place = {self.pieces[i]: i for i in usable}
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i, k in enumerate(self.kinds) if k == BYTE}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        normal = [self.scores[i] for i, k in enumerate(self.kinds) if k == NORMAL]
        # What an uncovered character costs, below every piece.
        self.penalty = min(normal, default=0.0) - 10.0
        # Each pair has one place, and the last one of a place is kept.
        self.apart = np.full(1 << CACHED_PAIRS_LOG2, -1, np.int64), np.zeros(1 << CACHED_PAIRS_LOG2, bool)
        self.words: dict[str, bytes] = {}
        self.cached = 0
        # A table by the first bits of a hash says which substrings may be pieces.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        # Pairs of codes that make a piece, with its rank (best score first) and its id.
        _, rank = np.unique(-self.scores, return_inverse=True)
        pairs = []
        for piece, i in self.place.items():
            for k in range(1, len(piece)):
                left, right = self.code(piece[:k]), self.code(piece[k:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, int(rank[i]), i))
        pairs.sort()
        self.pairs, self.pair_rank, self.pair_makes = (np.array([p[k] for p in pairs] or [-1], np.int64) for k in range(3))
        self.made = {(p[0] >> 32, p[0] & 0xFFFFFFFF): p[2] for p in pairs}
        self.made_rank = rank.tolist()
        self.of_char = {c: i for c, i in self.place.items() if len(c) == 1}
        self._decoding()

    def code(self, text: str) -> int | None:
        """The id of a piece, or a number above all ids for a character that is none."""
        found = self.place.get(text)
        return found if found is not None or len(text) > 1 else len(self.pieces) + ord(text)

    def _decoding(self) -> None:
        """The text of every id; plain: those that need no look at their neighbours."""
        text = ["" for _ in self.pieces]
        for i, kind in enumerate(self.kinds):
            if kind in (NORMAL, USER):
                text[i] = self.pieces[i].replace(SPACE, " ")
            elif kind == UNKNOWN:
                text[i] = " \u2047 "
        # A byte of ASCII is a character whatever stands beside it.
        for i, b in self.bytes.items():
            text[i] = chr(b) if b < 0x80 else ""
        raw = [t.encode() for t in text]
        self.text_lengths = np.array([len(t) for t in raw], np.int64)
        self.text_starts = np.cumsum(self.text_lengths) - self.text_lengths
        self.text_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.plain = np.ones(len(raw), bool)
        self.plain[[i for i, b in self.bytes.items() if b >= 0x80]] = False
        self.marked = np.array([p.startswith(SPACE) for p in self.pieces])


def load(path: str) -> Model:
    """A model from the bytes of a SentencePiece file, read with the library's own format."""
    from sentencepiece import sentencepiece_model_pb2 as format_of

    proto = format_of.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    kind = proto.trainer_spec.model_type
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models")
    if proto.normalizer_spec.precompiled_charsmap:
        raise ValueError("the model rewrites characters before encoding, which this operator does not do")
    return Model(
        [p.piece for p in proto.pieces],
        np.array([p.score for p in proto.pieces], np.float64),
        np.array([p.type for p in proto.pieces]),
        kind == BPE,
        proto.normalizer_spec.add_dummy_prefix,
        proto.normalizer_spec.remove_extra_whitespaces,
    )


def _hash_of(text: str) -> np.uint64:
    points = np.array([ord(c) for c in text], np.uint64)
    return _hashes(points[None, :], len(text))[0, 0]


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n code points from each column on; rows are words."""
    size = points.shape[1] - n + 1
    out = np.zeros((points.shape[0], size), np.uint64)
    for k in range(n):
        out = out * _POW + points[:, k : k + size] + np.uint64(1)
    return W.mix(out ^ np.uint64(n))


def merge(model: Model, text: str) -> list[int]:
    """The codes of a string after merging by score, the left one of equals first; by a heap of pairs."""
    n, total = len(text), len(model.pieces)
    code = [c if (c := model.of_char.get(t)) is not None else total + ord(t) for t in text]
    get, ranks = model.made.get, model.made_rank
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(ranks[m], i, i + 1, i + 2, m) for i in range(n - 1) if (m := get((code[i], code[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, k, m = heapq.heappop(heap)
        if end[i] != j or end[j] != k:
            continue
        code[i], end[i], end[j], before[k] = m, k, 0, i
        if k < n and (made := get((m, code[k]))) is not None:
            heapq.heappush(heap, (ranks[made], i, k, end[k], made))
        left = before[i]
        if left >= 0 and (made := get((code[left], m))) is not None:
            heapq.heappush(heap, (ranks[made], left, i, k, made))
    out, i = [], 0
    while i < n:
        out.append(code[i])
        i = end[i]
    return out


def _merged(model: Model, texts: list[str]) -> list[tuple[int, ...] | None]:
    """The codes of strings of one length after merging by score, the left one of equals first; None for more than two.

    All strings lose one pair at a time, side by side.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), -1).astype(np.int64)
    chars, back = np.unique(points, return_inverse=True)
    ids = np.array([model.code(chr(c)) for c in chars.tolist()], np.int64)[back.reshape(points.shape)]
    row, out = np.arange(len(texts)), [None] * len(texts)

    def joined(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left << 32 | right
        at = np.searchsorted(model.pairs, wanted)
        at[at == len(model.pairs)] = 0
        hit = model.pairs[at] == wanted
        return np.where(hit, model.pair_rank[at], NEVER), model.pair_makes[at]

    while len(row):
        width = ids.shape[1]
        if width == 1:
            done = np.ones(len(row), bool)
        else:
            rank, makes = joined(ids[:, :-1], ids[:, 1:])
            at = rank.argmin(1)
            done = rank[np.arange(len(row)), at] == NEVER
        if width <= 2:
            for i, codes in zip(row[done].tolist(), ids[done].tolist()):
                out[i] = tuple(codes)
        if width == 1 or done.all():
            break
        row, ids, at, makes = row[~done], ids[~done], at[~done], makes[~done]
        here = np.arange(len(row))
        ids[here, at] = makes[here, at]
        ids = np.take_along_axis(ids, np.arange(width - 1) + (np.arange(width - 1) > at[:, None]), 1)
    return out


def _stays_apart(model: Model, pairs: np.ndarray) -> np.ndarray:
    """For codes left * 2**32 + right (ids; left NONE for none): does merging leave exactly these two pieces?

    Ids from the number of pieces on are single characters that no piece covers.
    """
    known, answers = model.apart
    slot = W.mix(pairs.view(np.uint64)) >> np.uint64(64 - CACHED_PAIRS_LOG2)
    out = answers[slot]
    open_ = np.flatnonzero(known[slot] != pairs)
    if len(open_):
        new, back = np.unique(pairs[open_], return_inverse=True)
        total = len(model.pieces)
        text = lambda code: "" if code == NONE else model.pieces[code] if code < total else chr(code - total)
        wanted = [(code >> 32, code & 0xFFFFFFFF) for code in new.tolist()]
        glued = [text(a) + text(b) for a, b in wanted]
        fresh = np.empty(len(new), bool)
        by_length: dict[int, list[int]] = {}
        for i, t in enumerate(glued):
            by_length.setdefault(len(t), []).append(i)
        for some in by_length.values():
            texts = [glued[i] for i in some]
            merged = _merged(model, texts) if len(some) >= TOGETHER else [tuple(merge(model, t)) for t in texts]
            for i, codes in zip(some, merged):
                a, b = wanted[i]
                fresh[i] = codes == ((b,) if a == NONE else (a, b))
        out[open_] = fresh[back]
        slot = W.mix(new.view(np.uint64)) >> np.uint64(64 - CACHED_PAIRS_LOG2)
        known[slot], answers[slot] = new, fresh
    return out


def _search(model: Model, points: np.ndarray) -> np.ndarray:
    """Back pointers of words of one length (rows of code points): the piece (or character) ending at each place."""
    rows, n = points.shape
    total = len(model.pieces)
    none = np.int64(NONE)
    last = np.full((rows, n + 1), -1, np.int64)
    last[:, 0] = none
    value = np.full((rows, n + 1), -np.inf)
    value[:, 0] = 0.0
    found: list[np.ndarray] = []
    for size in range(1, min(model.longest, n) + 1):
        grams = _hashes(points, size).ravel()
        piece = np.full(len(grams), -1, np.int64)
        some = np.flatnonzero(model.maybe[grams >> np.uint64(44)])
        if len(some):
            at = np.searchsorted(model.keys, grams[some])
            at[at == len(model.keys)] = 0
            hit = model.keys[at] == grams[some]
            piece[some[hit]] = model.ids[at[hit]]
        piece = piece.reshape(rows, -1)
        if size == 1:  # any character may stand for itself
            own = total + points.astype(np.int64)
            found.append(np.where(piece >= 0, piece, own))
        else:
            found.append(piece)
    for end in range(1, n + 1):
        # The longest last piece first: of equal values it stays.
        for size in range(min(model.longest, end), 0, -1):
            piece = found[size - 1][:, end - size]
            before = last[:, end - size]
            ok = (piece >= 0) & (before >= 0)
            if model.bpe:  # at most one step to a place is allowed
                ok &= last[:, end] < 0
            live = np.flatnonzero(ok)
            if not len(live):
                continue
            p = piece[live]
            if model.bpe:
                kept = _stays_apart(model, (before[live] << 32) | p)
                live, p = live[kept], p[kept]
                gain = np.zeros(len(live))
            else:
                own = np.minimum(p, total - 1)
                gain = np.where(p < total, model.scores[own], model.penalty)
                # User-defined pieces win over whatever they hold.
                user = (p < total) & (model.kinds[own] == USER)
                gain = np.where(user, size * model.scores.max() - 0.1, gain)
            new = value[live, end - size] + gain
            better = new > value[live, end]
            live = live[better]
            value[live, end] = new[better]
            last[live, end] = p[better]
    return last


def _ids(model: Model, codes: list[int]) -> list[int]:
    """Pieces for the steps of a path; characters without a piece become bytes or the unknown piece."""
    total = len(model.pieces)
    out: list[int] = []
    for code in codes:
        if code < total:
            out.append(code)
        elif model.byte_ids:
            out.extend(model.byte_ids[b] for b in chr(code - total).encode("utf-8", "surrogatepass"))
        elif not out or out[-1] != model.unknown:  # a run of unknown characters is one piece
            out.append(model.unknown)
    return out


def _paths(model: Model, last: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The codes of each word, as the bytes of an int32 array, by following all back pointers at once; which hold no-pieces."""
    rows, n = len(last), last.shape[1] - 1
    total = len(model.pieces)
    steps = np.full((rows, n), -1, np.int64)
    every, end = np.arange(rows), np.full(rows, n)
    live = every
    for k in range(n - 1, -1, -1):
        code = last[live, end[live]]
        steps[live, k] = code
        end[live] -= np.where(code < total, model.lengths[np.minimum(code, total - 1)], 1)
        live = live[end[live] > 0]
        if not len(live):
            break
    held = steps >= 0
    flat = steps[held].astype(np.int32).tobytes()
    stops = (np.cumsum(held.sum(1)) * 4).tolist()
    return [flat[a:b] for a, b in zip([0, *stops], stops)], steps.max(axis=1, initial=0) >= total


def _codes(model: Model, words: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Codes of every word; words of one length are searched together, in batches of bounded size."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    out, odd = [b""] * len(words), np.zeros(len(words), bool)
    for n, places in by_length.items():
        if not n:
            continue
        if model.bpe and n > STRETCH + OVERLAP:
            for i in places:
                out[i], odd[i] = _long(model, words[i])
            continue
        step = max(1, CELLS // (n * model.longest))
        for at in range(0, len(places), step):
            some = places[at : at + step]
            text = "".join([words[i] for i in some]).encode("utf-32-le", "surrogatepass")
            points = np.frombuffer(text, np.uint32).reshape(len(some), n).astype(np.uint64)
            found, odd[some] = _paths(model, _search(model, points))
            for i, codes in zip(some, found):
                out[i] = codes
    return out, odd


def _long(model: Model, word: str) -> tuple[bytes, bool]:
    """Codes of a long word of a BPE model, from stretches that are searched side by side.

    A path all of whose neighbours stay apart is the only one there is. So two stretches are joined where both have a border
    and the pieces on its two sides stay apart.
    """
    total = len(model.pieces)
    starts = list(range(0, max(1, len(word) - OVERLAP), STRETCH))
    found, _ = _codes(model, [word[k : k + STRETCH + OVERLAP] for k in starts])

    def placed(codes: bytes, start: int) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(codes, np.int32).astype(np.int64)
        return codes, start + np.cumsum(np.where(codes < total, model.lengths[np.minimum(codes, total - 1)], 1))

    parts = [placed(codes, k) for k, codes in zip(starts, found)]
    done: list[np.ndarray] = []
    held = parts[0]
    for start, (codes, ends) in zip(starts[1:], parts[1:]):
        here = np.concatenate([[start], ends[:-1]])
        borders, left, right = np.intersect1d(held[1], here, assume_unique=True, return_indices=True)
        # Pieces next to where a stretch was cut are the least certain: places in the middle come first.
        order = np.argsort(np.abs(borders - start - OVERLAP // 2), kind="stable")
        left, right = left[order], right[order]
        apart = _stays_apart(model, held[0][left] << 32 | codes[right]) if len(left) else np.zeros(0, bool)
        if apart.any():
            k = int(apart.argmax())
            done.append(held[0][: left[k] + 1])
            held = codes[right[k] :], ends[right[k] :]
        else:
            # Such as one character over and over: the whole word is merged by its scores, which gives that path too.
            whole = np.array(merge(model, word), np.int64)
            return whole.astype(np.int32).tobytes(), bool((whole >= total).any())
    whole = np.concatenate([*done, held[0]])
    return whole.astype(np.int32).tobytes(), bool((whole >= total).any())


def encode_words(model: Model, words: list[str]) -> list[bytes]:
    """Ids of every word, as the bytes of an int32 array."""
    out, odd = _codes(model, words)
    for i in np.flatnonzero(odd).tolist():
        out[i] = array("i", _ids(model, np.frombuffer(out[i], np.int32).tolist())).tobytes()
    return out


def _units(model: Model, text: str) -> list[str]:
    """The text with its spaces marked, cut where no piece can reach across: before the spaces of each word."""
    if model.strip:
        text = " ".join(t for t in text.split(" ") if t)
    if not text:
        return []
    text = text.replace(" ", SPACE)
    if model.dummy_prefix:
        text = SPACE + text
    return text.split(SPACE)


def encode(model: Model, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of every text; null and empty texts have none. Equal words of a batch are searched once.

    Found words are kept for the next batch, but no more than CACHED_BYTES of them: a worker may wait long for it.
    """
    cache = model.words
    cut = [_cut(model, t) if t else [] for t in texts]
    units = {u for units in cut for u in units}
    new = list(units.difference(cache))
    found = encode_words(model, new)
    model.cached += sum(200 + 2 * len(u) + len(f) for u, f in zip(new, found))
    cache.update(zip(new, found))
    ids = [np.frombuffer(b"".join([cache[u] for u in units]), np.int32) for units in cut]
    if model.cached > CACHED_BYTES:
        cache.clear()
        model.cached = 0
    return ids


def _cut(model: Model, text: str) -> list[str]:
    """Words with the run of spaces before each; a run at the end of the text is a word of its own."""
    parts = _units(model, text)
    out, run = [], 0
    for k, part in enumerate(parts):
        if k:
            run += 1
        if part:
            out.append(SPACE * run + part)
            run = 0
    if run:
        out.append(SPACE * run)
    return out


def decode(model: Model, ids) -> str:
    """The text of ids: pieces joined, bytes read as UTF-8 (broken ones replaced), the added space dropped."""
    out, pending = [], bytearray()
    for i in ids:
        byte = model.bytes.get(int(i))
        if byte is not None:
            pending.append(byte)
            continue
        if pending:
            out.append(pending.decode("utf-8", "replace"))
            pending = bytearray()
        kind = model.kinds[i]
        if kind in (NORMAL, USER):
            out.append(model.pieces[i])
        elif kind == UNKNOWN:
            out.append(" ⁇ ")
    if pending:
        out.append(pending.decode("utf-8", "replace"))
    text = "".join(out)
    if model.dummy_prefix and text.startswith(SPACE):
        text = text[1:]
    return text.replace(SPACE, " ")


def decode_all(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of lists of ids in a row; those with byte pieces one by one, all others by joining bytes at once."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    lengths = model.text_lengths[ids]
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    flat = model.text_bytes[np.repeat(model.text_starts[ids], lengths) + inside].tobytes()
    at = np.concatenate([[0], np.cumsum(lengths)])[ends].tolist()
    odd = np.concatenate([[0], np.cumsum(~model.plain[ids])])[ends]
    # The added space is that of a first piece that begins with the mark for one; the unknown sign's own space stays.
    strip = np.zeros(len(counts), bool)
    some = np.flatnonzero(counts > 0)
    strip[some] = model.dummy_prefix & model.marked[ids[ends[some]]]
    out = []
    for k, (a, b) in enumerate(zip(at, at[1:])):
        if odd[k + 1] > odd[k]:
            out.append(decode(model, ids[ends[k] : ends[k + 1]]))
        else:
            out.append(flat[a + bool(strip[k]) : b].decode())
    return out


_LOADED: dict[str, Model] = {}


def _model(path: str) -> Model:
    """The model of this process; files of tokenizers are installed on every machine."""
    if path not in _LOADED:
        _LOADED[path] = load(path)
    return _LOADED[path]


def encode_column(documents: DataFrame, path: str, text: str = "text", decoded: str | None = None) -> DataFrame:
    """All columns of the documents with pieces (array<int>) and n_pieces. Null text: null pieces, 0.

    `decoded` names a column for the text that decoding the pieces gives, in the same pass over the rows.

    Empty texts have no pieces. Columns of these names are replaced. Every text is encoded whole. A task searches 4 MB of text at a
    time, or one longer text, and keeps caches of bounded size. `path` names a model file that is
    installed on every machine.
    """
    more = [decoded] if decoded else []
    documents = documents.drop("pieces", "n_pieces", *more)
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in W.slices(batches, text, BATCH_BYTES):
            column = batch.column(text)
            texts = column.to_pylist()
            ids = encode(model, texts)
            counts = np.array([len(i) for i in ids], np.int64)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            pieces = W.lists(flat, counts, pa.int32())
            if column.null_count:
                pieces = pa.ListArray.from_arrays(pieces.offsets, pieces.values, mask=column.is_null())
            columns = [*batch.columns, pieces, pa.array(counts)]
            if decoded:
                back = decode_all(model, flat.astype(np.int64), counts)
                columns.append(pa.array([None if t is None else b for t, b in zip(texts, back)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "pieces", "n_pieces", *more])

    schema = T.StructType(
        [*documents.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())]
        + [T.StructField(m, T.StringType()) for m in more]
    )
    return documents.mapInArrow(run, schema)


def decode_column(encoded: DataFrame, path: str, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """All columns with the text of the pieces; null for null. A column named `out` is replaced."""
    encoded = encoded.drop(out)
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(pieces)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = decode_all(model, lists.flatten().to_numpy().astype(np.int64), counts)
                texts = [t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, out])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())]))


def round_trips(text: str = "text", decoded: str = "decoded"):
    """Whether decoding gave the text back (the space mark itself reads as a space)."""
    return F.coalesce(F.replace(F.col(text), F.lit(SPACE), F.lit(" ")), F.lit("")) == F.coalesce(F.col(decoded), F.lit(""))
