"""Derivatives of WARC responses: metadata and plain-text conversion records that refer to them.

A record is a row: its type, id, target, date, the rest of its header fields, and its block. `derive` reads the HTTP message
in the block of each response and makes a metadata record (the source's header fields and digests, the HTTP status and
headers, the id of the conversion) and a conversion record (the visible text). `serialise` gives a record's bytes in WARC 1.1;
files are such bytes one after another, and `read` takes them apart again. `archive` does all of it in one pass over pages.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import words as W
from palimpsest.llm.html import render

_TEXT = pa.string()
RECORD_ARROW = pa.schema(
    [
        ("record_type", _TEXT),
        ("record_id", _TEXT),
        ("target_uri", _TEXT),
        ("record_date", _TEXT),
        ("fields", pa.map_(_TEXT, _TEXT)),
        ("block", pa.binary()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("record_date", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("block", T.BinaryType()),
    ]
)
_NAMES = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "record_date": "WARC-Date"}
# Rows a task turns into records at a time.
ROWS = 128
# Bytes that are taken off their compression at a time: what was read before an error counts.
STEP = 1 << 16


def digest(data: bytes) -> str:
    """The digest of a block or payload as archives write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def new_id(*parts: object) -> str:
    """A record id that follows from its parts, so that a task run again gives the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(parts, default=str))}>"


def _clean(value: str) -> str:
    """Header values stand on one line."""
    return re.sub(r"[\r\n]+", " ", value).strip()


def http_message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order, and payload of an HTTP response; without an empty line all is payload."""
    m = re.search(rb"\r?\n\r?\n", block)
    if not block.startswith(b"HTTP/") or m is None:
        return "", [], block
    first, *rest = block[: m.start()].decode("latin-1").replace("\r\n", "\n").split("\n")
    headers: list[tuple[str, str]] = []
    for line in rest:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = headers[-1][0], headers[-1][1] + " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            headers.append((name.strip(), value.strip()))
    return first, headers, block[m.end() :]


_CHUNK = re.compile(rb"\s*([0-9a-fA-F]+)[^\n]*\n")


def _unchunked(data: bytes) -> tuple[bytes, bool]:
    """The data of all chunks, and whether they are whole; what is no chunk, and all behind it, stays as it is."""
    out, at = [], 0
    while m := _CHUNK.match(data, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(out), True
        out.append(data[m.end() : m.end() + size])
        at = m.end() + size
    return b"".join([*out, data[at:]]), False


def inflate(data: bytes, window: int, start: int = 0) -> tuple[bytes, int, bool]:
    """The compressed member from a place on: its data as far as it can be read, where it ends, and whether it is whole."""
    member = zlib.decompressobj(window)
    out = []
    view = memoryview(data)
    for at in range(start, len(data), STEP):
        part = view[at : at + STEP]
        try:
            out.append(member.decompress(part))
        except zlib.error:
            return b"".join(out), at, False
        if member.eof:
            return b"".join(out), at + len(part) - len(member.unused_data), True
    return b"".join(out), len(data), False


def _uncompressed(data: bytes, coding: str) -> tuple[bytes, bool]:
    """All members of a payload; one that is not compressed as declared, as archives often hold it, stays as it is."""
    if coding == "deflate":
        for window in (zlib.MAX_WBITS, -zlib.MAX_WBITS):  # with its header, as it should be, or raw
            out, _, whole = inflate(data, window)
            if out or whole:
                return out, whole
        return data, not data
    out, at = [], 0
    while data[at : at + 2] == b"\x1f\x8b":
        part, at, whole = inflate(data, zlib.MAX_WBITS | 16, at)
        out.append(part)
        if not whole:
            return (b"".join(out), False) if any(out) else (data, False)
    if not out:
        return data, not data
    return b"".join(out), not data[at:].strip(b"\0")


def body(headers: dict[str, str], payload: bytes) -> tuple[bytes | None, bool]:
    """The payload without its transfer and content codings, and whether these were whole; None under an unknown coding."""
    whole = True
    if "chunked" in headers.get("transfer-encoding", "").lower():
        payload, whole = _unchunked(payload)
    for coding in reversed(headers.get("content-encoding", "").lower().split(",")):
        coding = coding.strip()
        if coding in ("gzip", "x-gzip", "deflate"):
            payload, ended = _uncompressed(payload, coding)
            whole = whole and ended
        elif coding not in ("", "identity", "none", "utf-8"):
            return None, whole
    return payload, whole


def is_text(kind: str) -> bool:
    """Whether a content type is one of text."""
    return kind.startswith("text/") or "html" in kind or "xml" in kind


def as_text(kind: str, data: bytes) -> str:
    """Data in the charset of its content type, or in UTF-8."""
    charset = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", kind)
    try:
        return data.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, UnicodeError):
        return data.decode("utf-8", "replace")


def _derived(record: dict, actual: dict[str, str] | None = None) -> list[dict]:
    """The metadata and, for text, the conversion record of a response; `actual` are its digests where they are known."""
    fields = dict(record["fields"] or [])
    block = record["block"] or b""
    status, headers, payload = http_message(block)
    by_name = {}
    for name, value in headers:
        by_name.setdefault(name.lower(), value)
    kept = {k: fields[k] for k in ("WARC-Payload-Digest", "WARC-Block-Digest") if k in fields}
    actual = actual or {"WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": digest(block)}
    common = {"WARC-Refers-To": record["record_id"]}
    if record["target_uri"] is not None:
        common["WARC-Refers-To-Target-URI"] = record["target_uri"]
    if record["record_date"] is not None:
        common["WARC-Refers-To-Date"] = record["record_date"]
    out = []
    kind = by_name.get("content-type", "text/html").lower()
    content, whole = body(by_name, payload) if is_text(kind) else (None, True)
    conversion = None
    if content is not None:
        source = as_text(kind, content)
        text = (render(source) if "html" in kind or "xml" in kind else source).encode("utf-8", "replace")
        conversion = new_id("conversion", record["record_id"])
        own = {"Content-Type": "text/plain; charset=utf-8", "WARC-Block-Digest": digest(text)}
        if "WARC-Payload-Digest" in fields:
            own["WARC-Source-Payload-Digest"] = fields["WARC-Payload-Digest"]
        out.append({"record_type": "conversion", "record_id": conversion, "fields": common | own, "block": text})
    told = {
        "source": {"WARC-Record-ID": record["record_id"], "WARC-Target-URI": record["target_uri"]} | fields,
        "http": {"status": status, "headers": [list(h) for h in headers]},
        "digests": {"recorded": kept, "computed": actual, "match": all(actual[k] == v for k, v in kept.items())},
        "payload_bytes": len(payload),
        "whole": whole,
        "conversion": conversion,
    }
    data = json.dumps(told, ensure_ascii=False).encode("utf-8", "replace")
    own = {"Content-Type": "application/json", "WARC-Block-Digest": digest(data)}
    out.insert(
        0, {"record_type": "metadata", "record_id": new_id("metadata", record["record_id"]), "fields": common | own, "block": data}
    )
    return [{"target_uri": record["target_uri"], "record_date": record["record_date"]} | r for r in out]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    rows = [r | {"fields": list(r["fields"].items())} for r in rows]
    return pa.RecordBatch.from_pylist(rows, RECORD_ARROW)


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all response records, with the columns of RECORD.

    Other types give none. A response whose payload is no text, or lies under a coding other than gzip and deflate, gives metadata
    only. Codings are taken off as far as they can be read; the metadata tell whether they were `whole`. A null block is an empty
    one; a null target or date is left out of the header; null fields are none; a null record id refers to nothing and is written
    as empty. Repeated rows give equal records. Digests that the source records are kept and checked against its block.
    """
    need = records.select(*RECORD.names).where(F.col("record_type") == "response")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS).to_pylist()
                yield _batch([d for r in rows for d in _derived(r | {"record_id": r["record_id"] or ""})])

    return need.mapInArrow(run, RECORD)


def responses(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as response records, all of one date, as a crawler would have stored them.

    A null page has an empty body, a null address no target. Ids follow from the page's id and address.
    """
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield _batch([_response(date, **r) for r in batch.slice(at, ROWS).to_pylist()])

    return plain.mapInArrow(run, RECORD)


def _response(date: str, page_id: object, url: str | None, html: str | None) -> dict:
    payload = (html or "").encode("utf-8", "replace")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    fields = {
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": digest(block),
        "WARC-Payload-Digest": digest(payload),
    }
    record = {"record_type": "response", "record_id": new_id(page_id, url), "fields": fields}
    return record | {"target_uri": url, "record_date": date, "block": block}


def archive(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The records that `derive` gives for the `responses` of pages, with their bytes (`warc`) and the size of their block in
    place of the block. One pass, in which a task holds some pages at a time and hashes each once."""
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    names = [n for n in RECORD.names if n != "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "html"):
            out = []
            for row in batch.to_pylist():
                source = _response(date, **row)
                out += _derived(source, {k: source["fields"][k] for k in ("WARC-Payload-Digest", "WARC-Block-Digest")})
            for r in out:
                r["fields"] = list(r["fields"].items())
            columns = [pa.array([r[n] for r in out], RECORD_ARROW.field(n).type) for n in names]
            sizes = pa.array([len(r["block"]) for r in out], pa.int64())
            data = pa.array([record_bytes(r) for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, sizes, data], names=[*names, "block_bytes", "warc"])

    kept = [f for f in RECORD.fields if f.name != "block"]
    added = [T.StructField("block_bytes", T.LongType()), T.StructField("warc", T.BinaryType())]
    return plain.mapInArrow(run, T.StructType([*kept, *added]))


def record_bytes(record: dict) -> bytes:
    """One record in WARC 1.1."""
    block = record["block"] or b""
    lines = ["WARC/1.1"]
    lines += [f"{name}: {_clean(record[k])}" for k, name in _NAMES.items() if record[k] is not None]
    lines += [f"{k}: {_clean(v)}" for k, v in record["fields"] if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def serialise(records: DataFrame, compress: bool = False) -> DataFrame:
    """All columns of the records with their bytes in WARC 1.1 (`warc`), gzipped one by one if asked for."""
    names = records.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = part.select(RECORD.names).to_pylist()
                data = [record_bytes(r | {"fields": r["fields"] or []}) for r in rows]
                if compress:
                    data = [gzip.compress(d, mtime=0) for d in data]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names=[*names, "warc"])

    return records.mapInArrow(run, T.StructType([*records.schema.fields, T.StructField("warc", T.BinaryType())]))


_HEAD = re.compile(rb"\s*WARC/1\.[01]\r?\n(.*?)\r?\n\r?\n", re.S)
# What follows a block, and where the next record begins behind one that is broken.
_ENDED = re.compile(rb"\r?\n\r?\n|\s*(?:WARC/1\.|\Z)")
_NEXT = re.compile(rb"(?<![^\n])WARC/1\.[01]\r?\n")


def _members(data: bytes) -> bytes:
    """The data of all gzip members; behind a broken one, whose readable part counts, the next that can be read goes on."""
    parts, at = [], 0
    while at >= 0:
        part, end, whole = inflate(data, zlib.MAX_WBITS | 16, at)
        parts.append(part)
        at = data.find(b"\x1f\x8b\x08", end if whole else at + 1)
        if part and not whole:
            parts.append(b"\n")  # so that the next record stands at the start of a line
    return b"".join(parts)


def records_in(data: bytes) -> Iterator[dict]:
    """The records of a file's bytes, plain or gzipped by record.

    A record that is broken (its length missing or no number, or its block cut off by the end or by the next record of a file) has
    the block that is there and the field WARC-Truncated. Bytes between records that belong to none are passed over.
    """
    if data[:2] == b"\x1f\x8b":
        data = _members(data)
    known = {v.lower(): k for k, v in _NAMES.items()}
    at = 0
    while at < len(data):
        m = _HEAD.match(data, at)
        if m is None:
            later = _NEXT.search(data, at + 1)
            if later is None:
                return
            at = later.start()
            continue
        record: dict = dict.fromkeys(RECORD.names) | {"fields": {}}
        size = -1
        for line in m[1].decode("utf-8", "replace").replace("\r\n", "\n").split("\n"):
            name, _, value = line.partition(":")
            key = known.get(name.strip().lower())
            if key:
                record[key] = value.strip()
            elif name.strip().lower() == "content-length":
                size = int(value) if re.fullmatch(r"\s*[0-9]{1,18}\s*", value) else -1
            else:
                record["fields"][name.strip()] = value.strip()
        end = m.end() + size
        if size < 0 or end > len(data) or not _ENDED.match(data, end):
            # The block's length is wrong: it ends before the next record.
            later = _NEXT.search(data, m.end())
            end = later.start() if later else len(data)
            block = data[m.end() : end]
            record["block"] = block.removesuffix(b"\n").removesuffix(b"\r").removesuffix(b"\n").removesuffix(b"\r")
            record["fields"].setdefault("WARC-Truncated", "unspecified")
        else:
            record["block"] = data[m.end() : end]
        yield record
        at = end


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files; a task holds one file at a time."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for record in records_in(content.as_py()):
                    rows.append(record)
                    if len(rows) == ROWS:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(run, RECORD)
