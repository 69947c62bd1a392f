"""Language identification by compression.

A zstandard dictionary of raw text is kept for every language. A text is compressed with each of
them, in blocks, so that a dictionary counts for all of a long text and not for its beginning
only; the dictionary that gives the fewest bytes names the language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W

# Fitting takes about so many rows of each language and so many characters of each: 256 KB a language.
ROWS = 256
PIECE = 1000
LEVEL = 6
BLOCK = 2048
# The best dictionary must save this share of the second best's bytes.
MARGIN = 0.002
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    """Languages, the more frequent first (of equal sizes the first wins), and their dictionaries."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document belongs to the fold; one without an id does, so nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = ROWS) -> Model:
    """Dictionaries from a bounded sample: about `rows` texts of each language, PIECE characters of each.

    Rows are chosen by a hash of their text, the same ones in any partitioning; equal texts count once.
    Null languages and null or empty texts teach nothing. Without any row there is no language.
    """
    known = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Model((), ())
    keyed = known.withColumn("at", F.pmod(F.xxhash64("text"), F.lit(1 << 30)))
    share = F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, int(min(1, rows / n) * (1 << 30)))])
    begin = F.when(F.length("text") > PIECE, F.pmod(F.xxhash64("text", F.lit(1)), F.length("text") - PIECE))
    sample = (
        keyed.where(F.col("at") < share[F.col("lang")])
        .select("lang", "at", F.col("text").substr(F.coalesce(begin, F.lit(0)).cast("int") + 1, F.lit(PIECE)).alias("t"))
        .distinct()
        .collect()
    )
    parts: dict[str, list] = {lang: [] for lang in counts}
    for r in sorted(sample, key=lambda r: (r["lang"], r["at"], r["t"])):
        parts[r["lang"]].append(r["t"].encode())
    order = sorted(counts, key=lambda x: (-counts[x], x))
    return Model(tuple(order), tuple(b"\n".join(parts[x]) for x in order))


def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in model.dictionaries:
        # Text too short for a dictionary is padded; the padding is the same for all languages.
        own = zstandard.ZstdCompressionDict(content.ljust(64), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return out


def sizes(compressors, text: str) -> list[int]:
    data = text.encode("utf-8", "replace")
    blocks = [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
    return [sum(len(c.compress(b)) for b in blocks) for c in compressors]


def identify(
    documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", margin: float = MARGIN
) -> DataFrame:
    """All columns of the documents with lang_pred, lang_score (0 to 1) and lang_rejected.

    lang_pred is the language of the smallest dictionary code (of equal ones the language more frequent in
    training). lang_score is the share of bytes saved over the second best. lang_rejected: the share
    is below `margin`, or the text is null or has no letter: then lang_pred is `und` and the score 0. With
    one language only, its score is 1; with none, all are `und`. Columns of these three names are replaced.
    """
    documents = documents.drop("lang_pred", "lang_score", "lang_rejected")
    names = documents.columns
    languages = model.languages
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(sent.value)
        for batch in W.slices(batches, text):
            pred, score, rejected = [], [], []
            for value in batch.column(text):
                t = value.as_py()
                if not languages or t is None or not _LETTER.search(t):
                    pred.append(UNKNOWN), score.append(0.0), rejected.append(True)
                    continue
                size = sizes(compressors, t)
                best, *rest = sorted(range(len(size)), key=size.__getitem__)
                saved = 1 - size[best] / size[rest[0]] if rest else 1.0
                pred.append(languages[best]), score.append(saved), rejected.append(saved < margin)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*names, "lang_pred", "lang_score", "lang_rejected"],
            )

    schema = T.StructType(
        [
            *documents.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("lang_score", T.DoubleType()),
            T.StructField("lang_rejected", T.BooleanType()),
        ]
    )
    return documents.mapInArrow(run, schema)
