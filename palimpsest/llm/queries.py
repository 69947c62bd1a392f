"""One query for each operator, over its whole table, with SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import bpe, chat, decontam, divergence, html, itq, jaccard, langid, lm, pieces, runs, toxicity, warc
from palimpsest.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# A model of 32,000 pieces, installed with the public vocabulary files on every machine.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op1_chat(spark: SparkSession, data: str) -> DataFrame:
    """All conversations in windows of a token budget, read back; with one whose texts hold control strings."""
    turns = table(spark, data, "conversations").select("conv_id", "turn", "role", "text")
    held = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", held), (-7, 1, "assistant", held)], turns.schema)
    return chat.digests(chat.format_chats(turns.union(tricky)))


@query()
def op2_html(spark: SparkSession, data: str) -> DataFrame:
    """The visible text of every page."""
    found = html.extract(table(spark, data, "pages"))
    text = F.col("visible_text")
    return found.select(
        "page_id",
        F.length(text).cast("long").alias("n_chars"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        text,
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
DECONTAM_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     windows AS (
       SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS g
       FROM i, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS t(p) WHERE len(w) > 0),
     grams AS (
       SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
       FROM d, (SELECT DISTINCT n FROM windows) AS s, unnest(generate_series(1, len(w) - n + 1)) AS t(p)),
     met AS (SELECT doc_id, p, n, item_id FROM grams JOIN windows USING (n, g)),
     hit AS (
       SELECT doc_id, count(DISTINCT q) AS n_hit
       FROM met, unnest(generate_series(p, p + n - 1)) AS t(q) GROUP BY doc_id),
     items AS (
       SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# Shingles as strings; the words of a set are paired only where they meet in one.
JACCARD_SQL = r"""
WITH RECURSIVE w AS (
       SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
     s AS (
       SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
       FROM w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(p) WHERE len(w) > 0),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     shared AS (
       SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
       FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
     links AS (
       SELECT x, y FROM shared JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y
       WHERE 100 * k >= 80 * (a.n + b.n - k)),
     reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, lowest AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS lowest FROM reach GROUP BY doc_id) USING (doc_id)
"""

ITQ_SQL = """
WITH RECURSIVE v AS (
       SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
       WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     links AS (
       SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
       WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
     n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x),
     reach AS (
       SELECT vec_id, vec_id AS r FROM embeddings
       UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.r),
     low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN n USING (vec_id)
"""


@query(DECONTAM_SQL)
def op3_decontaminate(spark: SparkSession, data: str) -> DataFrame:
    """Words of documents in windows of ten words of a benchmark item."""
    found = decontam.decontaminate(table(spark, data, "documents"), table(spark, data, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# Crawl date of the pages, which the table does not hold.
CRAWLED = "2024-01-01T00:00:00Z"


@query()
def op4_warc(spark: SparkSession, data: str) -> DataFrame:
    """Metadata and conversion records of every page, as rows and as bytes of a WARC file."""
    fields = F.col("fields")
    return warc.archive(table(spark, data, "pages"), CRAWLED).select(
        "record_type",
        "record_id",
        fields["WARC-Refers-To"].alias("refers_to"),
        "target_uri",
        "record_date",
        fields["WARC-Block-Digest"].alias("block_digest"),
        fields["WARC-Source-Payload-Digest"].alias("source_payload_digest"),
        "block_bytes",
        "warc",
    )


@query(JACCARD_SQL)
def op5_jaccard(spark: SparkSession, data: str) -> DataFrame:
    """Components of documents that share four fifths of their shingles of five words."""
    return jaccard.near_duplicates(table(spark, data, "documents"))


@query()
def op6_lm(spark: SparkSession, data: str) -> DataFrame:
    """The pseudo-likelihood of every document."""
    return lm.fit_and_score(table(spark, data, "documents"), keep=["doc_id"])


@query(ITQ_SQL)
def op7_itq(spark: SparkSession, data: str) -> DataFrame:
    """Links and components of embeddings with a cosine of at least 0.9."""
    return itq.near_duplicates(table(spark, data, "embeddings"))


@query()
def op8_toxicity(spark: SparkSession, data: str) -> DataFrame:
    """Toxicity of every document, learned without the fold that is held out."""
    documents = table(spark, data, "documents").select("doc_id", "text")
    out = langid.held_out(F.col("doc_id"), 5, 0)
    labels = table(spark, data, "labels").where(~out)
    scored = toxicity.score(documents, toxicity.fit(documents, labels))
    return scored.select(
        "doc_id", out.alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("predicted")
    )


@query()
def op9_language(spark: SparkSession, data: str) -> DataFrame:
    """Language of every document, learned without the fold that is held out."""
    documents = table(spark, data, "documents")
    out = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(documents.where(~out))
    found = langid.identify(documents.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        out.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


@query()
def op10_pieces(spark: SparkSession, data: str) -> DataFrame:
    """Every document as ids of pieces, and whether decoding them gives its text back."""
    documents = table(spark, data, "documents").select("doc_id", "text")
    decoded = pieces.encode_column(documents, PIECES, decoded="decoded")
    return decoded.select("doc_id", "n_pieces", "pieces", pieces.round_trips().alias("round_trip"))


DIVERGENCE_SQL = r"""
WITH d AS (
       SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
     t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
     kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
     v AS (SELECT lang, count(*) AS v, sum(n) AS words FROM kept GROUP BY lang),
     cell AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
     g AS (
       SELECT lang, source, coalesce(sum(n), 0) AS total
       FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN cell USING (lang, source) GROUP BY lang, source),
     p AS (
       SELECT g.lang, g.source, kept.term, coalesce(cell.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(cell.n, 0) + 2) // (total + 2 * v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (kept.n + 2) // (words + 2 * v) AS q
       FROM g JOIN kept USING (lang) JOIN v USING (lang)
         LEFT JOIN cell ON cell.lang = g.lang AND cell.source = g.source AND cell.term = kept.term),
     sums AS (
       SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
       FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     every AS (
       SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
       FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
       UNION ALL
       SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
     ranked AS (
       SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query(DIVERGENCE_SQL)
def op11_divergence(spark: SparkSession, data: str) -> DataFrame:
    """How far the sources of each language are from one another, and the terms they use more than their language."""
    return divergence.audit(table(spark, data, "documents"))


def planted(documents: DataFrame) -> DataFrame:
    """Documents of which a tenth repeat some of their words from a word on, by a rule on their id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = documents.select(
        "doc_id",
        "text",
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"),
        F.floor(h / 10).alias("g"),
    )
    first = words.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = first.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    places = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1),
        lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return period.select("doc_id", F.when(F.col("n") > 0, F.array_join(places, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op12_runs(spark: SparkSession, data: str) -> DataFrame:
    """Periodic runs of words in every document, the strongest one, and the text without repetitions."""
    found = runs.find_runs(planted(table(spark, data, "documents")))

    def stronger(a, b):
        return F.when(
            a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b
        ).otherwise(a)

    kind = found.schema["runs"].dataType.elementType.simpleString()
    best = F.aggregate("runs", F.lit(None).cast(kind), stronger)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_bpe(spark: SparkSession, data: str) -> DataFrame:
    """Every document as ids of byte-level BPE, and the bytes they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, data, "documents").select("doc_id", "text")
    decoded = bpe.decode_column(bpe.encode_column(documents, ranks), ranks)
    none = F.lit(b"")
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.coalesce("tokens", none), 256).alias("ids_sha256"),
        F.sha2(F.coalesce("decoded", none), 256).alias("decoded_sha256"),
    )
