"""Versioned and keyed tables as Parquet files, with all-or-nothing commits.

    <table>/data/<folder>/_part=open/_bucket=<b>      the current rows of bucket b after the folder's commit
    <table>/data/<folder>/_part=closed                 the rows closed by that commit
    <table>/commits/<n>                                the marker of commit n, written last

Every run writes to a folder of its own, and a marker names the folders that make up the table after its commit:
for each bucket the one that last wrote its open rows, and those with closed rows, with their times. A
merge reads and writes only the buckets its batch falls into. A reader needs the last marker alone, so a commit
shows as a whole or not at all. Markers are numbered without gaps and created only where there is none: of two writers with
the same number one fails. A run that died leaves a folder no marker names.

Closed rows are written anew in two cases only. Once some commits have added their folders, `compact` puts those into files ranged
by the end of validity, so that the number of folders grows with the logarithm of the commits. And late rows
(`merge_late`) replace the files that hold their keys, and no others.

Columns change without a rewrite: a marker holds the schemas the table has had and the steps between them, and files
of an older schema take the steps since then while they are read (`evolve`).

A marker also remembers for every source (a stream, a refresh) the number of its last batch. The same
batch of the same source again changes nothing and returns the stored outcomes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.times import Moment, position
from palimpsest.operators.evolve import Cast, Drop, Rename, Step, empty_frame, step_from_dict, step_to_dict, upgrade
from palimpsest.operators.history import VERSIONING, as_of, history_from_log
from palimpsest.operators.merge import (
    CLOSED,
    OPEN,
    OUTCOME,
    PART,
    UPSERTED,
    keyed_upsert,
    merge_log,
    outcome_columns,
    require_keys,
    scd2_merge,
)
from palimpsest.operators.slices import ROWS_PER_SLICE
from palimpsest.spec import ResourceSpec

# A batch whose rows take at most so many bytes as text is broadcast in a merge.
SMALL_BYTES = 8 * 2**20

# Like the merge's own columns, so that tables may use any name without an underscore.
BUCKET = "_bucket"

# So many folders of closed rows of one tier are compacted into one of the next, with files of about so many rows.
FANOUT = 16
ROWS_PER_FILE = 4_000_000

# A task of a commit sorts and writes about so many rows at most.
ROWS_PER_TASK = 1_000_000

_EPOCH = datetime(1970, 1, 1)

# A stream or another repeatable writer, and the number of its batch.
Source = tuple[str, int]


def micros(ts: datetime | str) -> int:
    """A time in microseconds; without a zone it is UTC."""
    parsed = datetime.fromisoformat(ts) if isinstance(ts, str) else ts
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc).replace(tzinfo=None)
    return (parsed - _EPOCH) // timedelta(microseconds=1)


class Commits:
    """The commit markers of one table, on any file system Spark can write to."""

    def __init__(self, spark: SparkSession, table: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._dir = f"{table}/commits"

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._dir}/{name}" if name else self._dir)

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        """The numbers of all markers, in order."""
        fs = self._fs()
        if not fs.exists(self._path()):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._path())]
        return sorted(int(n) for n in names if n.isdigit())

    def text(self, path: str) -> str:
        stream = self._fs().open(self._jvm.org.apache.hadoop.fs.Path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, number: int) -> dict | None:
        """A marker; None for one that its writer did not finish."""
        try:
            return json.loads(self.text(f"{self._dir}/{number:010d}"))
        except json.JSONDecodeError:
            return None

    def last(self) -> tuple[int, dict]:
        """The number of the next commit, and the last finished marker (empty without one)."""
        numbers = self.numbers()
        for number in reversed(numbers):
            body = self.read(number)
            if body is not None:
                return numbers[-1] + 1, body
        return (numbers[-1] + 1 if numbers else 0), {}

    def write(self, number: int, body: dict) -> None:
        """Creates the marker; fails if another writer has."""
        out = self._fs().create(self._path(f"{number:010d}"), False)
        try:
            out.write(bytearray(json.dumps(body).encode()))
        finally:
            out.close()

    def delete(self, path: str) -> bool:
        return self._fs().delete(self._jvm.org.apache.hadoop.fs.Path(path), True)

    def exists(self, path: str) -> bool:
        return self._fs().exists(self._jvm.org.apache.hadoop.fs.Path(path))

    def files(self, path: str) -> list[str]:
        """All Parquet files below a folder."""
        found, out = self._fs().listFiles(self._jvm.org.apache.hadoop.fs.Path(path), True), []
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(".parquet"):
                out.append(name)
        return out

    def stored(self, body: dict, source: Source | None) -> dict[str, int] | None:
        """The outcomes of a source's batch if it is committed already."""
        done = body.get("sources", {}).get(source[0]) if source else None
        if done is None or done["batch"] < source[1]:
            return None
        if done["batch"] > source[1]:
            raise ValueError(f"batch {source[1]} of {source[0]} comes after batch {done['batch']}")
        return done["outcomes"]

    def publish(self, number: int, before: dict, source: Source | None, outcomes: dict[str, int], body: dict) -> None:
        """Writes the next marker, with what it takes over from the one before."""
        sources = dict(before.get("sources", {}))
        if source:
            sources[source[0]] = {"batch": source[1], "outcomes": outcomes}
        self.write(number, body | {"outcomes": outcomes, "sources": sources})


class _Evolving:
    """Reading files of older schemas, and changing the schema; for tables with markers."""

    spark: SparkSession
    path: str
    keys: list[str]
    schema: T.StructType
    commits: Commits

    def _checked(self, body: dict) -> dict:
        """The marker, if the table has the columns this object was made for."""
        if "schemas" in body:
            has, wants = ({f.name: f.dataType for f in s.fields} for s in (self._schemas(body)[-1][1], self.schema))
            differ = sorted(n for n in {*has, *wants} if has.get(n) != wants.get(n))
            if differ:
                raise ValueError(f"{self.path} has other columns than expected: {differ}; see evolve")
        return body

    def _schemas(self, body: dict) -> list[tuple[int, T.StructType]]:
        """The schemas the table has had, each with the number of the first commit under it."""
        return [(n, T.StructType.fromJson(s)) for n, s in body.get("schemas", [])] or [(0, self.schema)]

    def _schema_notes(self, before: dict, number: int) -> dict:
        """What the next marker says about schemas."""
        return {"schemas": before.get("schemas", [[number, self.schema.jsonValue()]]), "steps": before.get("steps", [])}

    def _frame(self, body: dict, places: Sequence[tuple[str, Sequence[str]]], file: str | None = None) -> DataFrame:
        """Rows of (folder, its paths) under the newest schema; `file` names a column for the file each row is in."""
        schemas = self._schemas(body)
        by_schema: dict[int, list[str]] = {}
        for folder, paths in places:
            since = sum(n <= int(folder.partition("-")[0]) for n, _ in schemas)
            by_schema.setdefault(max(since, 1) - 1, []).extend(paths)
        more = [file] if file else []
        out = None
        for k, paths in sorted(by_schema.items()):
            if not paths:
                continue
            # The folders are named one by one: nothing is to be inferred from their names.
            rows = self.spark.read.schema(schemas[k][1]).option("recursiveFileLookup", True).parquet(*paths)
            if file:
                rows = rows.withColumn(file, F.col("_metadata.file_path"))
            rows = upgrade(rows, [step_from_dict(s) for n, s in body.get("steps", []) if n > schemas[k][0]])
            rows = rows.select(*self.schema.names, *more)
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            return empty_frame(self.spark, T.StructType([*self.schema.fields, *[T.StructField(m, T.StringType()) for m in more]]))
        return out

    def _all_rows(self, body: dict) -> DataFrame:
        raise NotImplementedError

    def _evolved(self, steps: Sequence[Step], fixed: Sequence[str], check: bool) -> tuple[T.StructType, list[str]]:
        """Commits steps without writing rows; returns the new schema and keys.

        Columns named in `fixed` may be renamed if they are keys, and not otherwise changed.
        """
        number, body = self.state()
        keys, held = list(self.keys), set(fixed)
        for step in steps:
            if isinstance(step, Rename):
                if step.old in held and step.old not in keys:
                    raise ValueError(f"{step.old} cannot be renamed")
                keys = [step.new if k == step.old else k for k in keys]
                held = {step.new if k == step.old else k for k in held}
            elif isinstance(step, (Cast, Drop)) and step.column in held:
                raise ValueError(f"{step.column} cannot be changed")
        after = upgrade(empty_frame(self.spark, self.schema), steps)
        if body:
            casts = [s.column for s in steps if isinstance(s, Cast)]
            cast = [c for c in casts if c in after.columns]
            if check and cast:
                # A value that does not fit is found now rather than by every later read.
                upgrade(self._all_rows(body), steps).select(*cast).write.format("noop").mode("overwrite").save()
            notes = self._schema_notes(body, number)
            self.commits.write(
                number,
                body
                | {
                    "schemas": notes["schemas"] + [[number, after.schema.jsonValue()]],
                    "steps": notes["steps"] + [[number, step_to_dict(s)] for s in steps],
                },
            )
        return after.schema, keys


class HistoryStore(_Evolving):
    """A versioned table.

    Its open rows lie in `buckets` parts by the first key column. Full snapshots of a table need one;
    where batches cover a few networks or devices at a time, many buckets keep a merge as
    small as its batch. The number is fixed for the life of a table; None takes what the table has.
    Commits compact closed rows once `fanout` folders of a tier are there; None leaves that to `compact`.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: T.StructType,
        json_cols: Sequence[str] = (),
        buckets: int | None = None,
        fanout: int | None = FANOUT,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.schema, self.json_cols = list(keys), schema, list(json_cols)
        versioning = ("active_from", "active_to", "last_seen")
        self.values = [n for n in schema.names if n not in (*keys, *versioning)]
        self.commits = Commits(spark, self.path)
        self.buckets = buckets or self.commits.last()[1].get("buckets", 1)
        self.fanout = fanout

    @classmethod
    def of(
        cls, spark: SparkSession, root: str, spec: ResourceSpec, buckets: int | None = None
    ) -> HistoryStore:
        return cls(spark, f"{root}/{spec.name}", spec.keys, spec.schema, spec.json_cols, buckets)

    def _data(self, folder: str) -> str:
        return f"{self.path}/data/{folder}"

    def _bucket_of(self, key: Column) -> Column:
        if self.buckets == 1:
            return F.lit(0)
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _bucket(self) -> Column:
        return self._bucket_of(F.col(self.keys[0]).cast(self.schema[self.keys[0]].dataType))

    def state(self) -> tuple[int, dict]:
        """The number of the next commit, and the marker that says what the table holds."""
        number, body = self.commits.last()
        if body.get("buckets", self.buckets) != self.buckets:
            raise ValueError(f"{self.path} has {body['buckets']} buckets, not {self.buckets}")
        return number, self._checked(body)

    def _open_dir(self, bucket: int | str, folder: str) -> str:
        return f"{self._data(folder)}/{PART}={OPEN}/{BUCKET}={bucket}"

    def _open_rows(self, body: dict, buckets: set[int] | None = None) -> DataFrame:
        parts = body.get("open", {})
        wanted = [(f, [self._open_dir(b, f)]) for b, f in parts.items() if buckets is None or int(b) in buckets]
        return self._frame(body, wanted)

    def open_rows(self, key: object = None) -> DataFrame:
        """Current rows; with a value of the first key column, the bucket that holds it."""
        body = self.state()[1]
        if key is None or self.buckets == 1:
            return self._open_rows(body)
        typed = F.lit(key).cast(self.schema[self.keys[0]].dataType)
        found = self.spark.range(1).select(self._bucket_of(typed)).first()[0]
        return self._open_rows(body, {found})

    def _closed_dir(self, entry: dict) -> str:
        part = "" if entry.get("part") is None else f"/{BUCKET}={entry['part']}"
        return f"{self._data(entry['folder'])}/{PART}={CLOSED}{part}"

    def _closed_paths(self, entry: dict) -> list[str]:
        """The folder of an entry, or its files where late rows have replaced some."""
        folder = self._closed_dir(entry)
        if not entry.get("gone"):
            return [folder]
        return [f for f in self.commits.files(folder) if f.rpartition("/")[2] not in entry["gone"]]

    def _closed_rows(self, body: dict, entries: Sequence[dict], file: str | None = None) -> DataFrame:
        return self._frame(body, [(e["folder"], self._closed_paths(e)) for e in entries], file)

    def closed_rows(self, after: Moment | None = None, before: Moment | None = None) -> DataFrame:
        """Closed rows; without the folders that hold none valid later than `after`, or none from `before` or earlier."""
        body = self.state()[1]
        low, high = (None if t is None or isinstance(t, Column) else micros(t) for t in (after, before))
        entries = [
            e
            for e in body.get("closed", [])
            if (low is None or e["to"] > low) and (high is None or e["from"] <= high)
        ]
        return self._closed_rows(body, entries)

    def _all_rows(self, body: dict) -> DataFrame:
        return self._closed_rows(body, body.get("closed", [])).unionByName(self._open_rows(body))

    def history(self) -> DataFrame:
        """All versions."""
        return self.closed_rows().unionByName(self.open_rows())

    def at(self, ts: Moment | None = None, key: object = None) -> DataFrame:
        """Current rows (None), all versions ("all"), or the rows valid at `ts`.

        Current rows read no closed file. `key` is a value of the first key column: other buckets of
        open rows are not read, and the caller filters.
        """
        if ts is None:
            return self.open_rows(key)
        if isinstance(ts, str) and ts == "all":
            return self.closed_rows().unionByName(self.open_rows(key))
        return as_of(self.closed_rows(ts, ts).unionByName(self.open_rows(key)), ts)

    def _seen(self, batch: DataFrame, *more: Column) -> tuple[dict, set[int]]:
        """What one pass over a batch says: aggregates, and its buckets."""
        found = batch.agg(
            F.count(F.lit(1)).alias("rows"),
            # No more than the table has.
            F.collect_set(self._bucket()).alias("buckets"),
            *more,
        ).first()
        return found.asDict(), set(found["buckets"])

    def merge(
        self,
        batch: DataFrame,
        ts: datetime | str,
        source: Source | None = None,
        small_bytes: int = SMALL_BYTES,
        **options,
    ) -> dict[str, int]:
        """Merges a snapshot taken at `ts`; returns the outcome counts, zeros included.

        A batch of at most `small_bytes` is broadcast. The batch is read twice: for its size and buckets, and
        for the merge; write an expensive one first.
        """
        number, body = self.state()
        done = self.commits.stored(body, source)
        if done is not None:
            return done
        if body and micros(ts) <= body["time"]:
            raise ValueError(f"snapshot of {ts} is not newer than the last commit")
        text = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in batch.columns])))
        seen, touched = self._seen(batch, F.coalesce(F.sum(text), F.lit(0)).alias("bytes"))
        if not seen["rows"]:
            return self._no_outcomes()
        merged = scd2_merge(
            self._open_rows(body, touched),
            batch,
            self.keys,
            self.values,
            ts,
            self.json_cols,
            small_batch=seen["bytes"] <= small_bytes,
            **options,
        )
        about = seen["rows"] + self._open_rows(body, touched).count()
        return self._commit(merged, number, body, micros(ts), touched, source, about)

    def merge_log(
        self,
        log: DataFrame,
        at: str,
        tiebreak: Sequence[str] = (),
        source: Source | None = None,
        rows_per_slice: int | None = ROWS_PER_SLICE,
    ) -> dict[str, int]:
        """Appends a log batch with several times per key; batches must come in time order."""
        number, body = self.state()
        done = self.commits.stored(body, source)
        if done is not None:
            return done
        place = position(F.col(at), log.schema[at].dataType)
        untimed = F.count_if(F.col(at).isNull()).alias("untimed")
        seen, touched = self._seen(log, F.min(place).alias("first"), F.max(place).alias("last"), untimed)
        if not seen["rows"]:
            return self._no_outcomes()
        if seen["untimed"]:
            raise ValueError(f"{seen['untimed']} row(s) of the log have no {at}")
        if rows_per_slice is not None and seen["rows"] <= rows_per_slice:
            # No key can be hot in a batch this small.
            rows_per_slice = None
        if body and seen["first"] < body["time"]:
            first = _EPOCH + timedelta(microseconds=seen["first"])
            raise ValueError(f"log batch from {first} is older than the last commit")
        merged = merge_log(
            self._open_rows(body, touched),
            log,
            self.keys,
            self.values,
            at,
            tiebreak,
            self.json_cols,
            rows_per_slice,
        )
        about = seen["rows"] + self._open_rows(body, touched).count()
        return self._commit(merged, number, body, seen["last"], touched, source, about)

    def load(self, history: DataFrame, ts: datetime | str) -> None:
        """The first commit of a table from a finished history, seen up to `ts`.

        Fails if the history knows of anything later than `ts`.
        """
        number, body = self.state()
        if body:
            raise ValueError(f"{self.path} has commits already")
        times = [position(F.col(c), history.schema[c].dataType) for c in ("active_from", "active_to", "last_seen")]
        latest = history.agg(*[F.max(t) for t in times], F.collect_set(self._bucket()), F.count(F.lit(1))).first()
        if any(t is not None and t > micros(ts) for t in latest[:3]):
            raise ValueError(f"the history goes on after {ts}")
        part = F.when(F.col("active_to").isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
        tagged = history.select(*self.schema.names, part.alias(PART)).withColumn(
            OUTCOME, F.lit(None).cast("string")
        )
        self._commit(tagged, number, body, micros(ts), set(latest[3]), None, latest[4])

    def _no_outcomes(self) -> dict[str, int]:
        return {"inserted": 0, "updated": 0, "expired+inserted": 0}

    def _instant(self, column: str) -> Column:
        """Microseconds of a time of validity."""
        kind = self.schema[column].dataType
        if isinstance(kind, T.DateType):
            return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000_000
        return position(F.col(column), kind)

    def _write(self, rows: DataFrame, number: int, *seen: Column, about: int = 0) -> tuple[str, dict]:
        """Writes rows with PART to a folder of their own, and what was seen of them.

        `about` is how many rows there are. Adaptive execution deals rows by their bytes as shuffled, and narrow or
        repetitive rows take many times that in a sort: more than a task should hold are dealt by their number.
        """
        # Closed rows are not read by bucket: those of a commit stay together.
        bucket = F.when(F.col(PART) == OPEN, self._bucket()).otherwise(F.lit(0))
        noted = Observation()
        sizes = [F.count_if(F.col(PART) == part).alias(f"{part}_rows") for part in (OPEN, CLOSED)]
        closed = F.col(PART) == CLOSED
        times = [
            F.min(F.when(closed, self._instant("active_from"))).alias("first"),
            F.max(F.when(closed, self._instant("active_to"))).alias("last"),
        ]
        # Counted in the stage that writes: a retried task counts once. Few files per bucket, a hot bucket still
        # spread over several tasks; within a file the order by which it is read.
        placed = rows.withColumn(BUCKET, bucket)
        tasks = -(-about // ROWS_PER_TASK)
        if tasks > 1:
            dealt = placed.repartitionByRange(tasks, PART, BUCKET, *self.keys, "active_to")
        else:
            dealt = placed.hint("rebalance", PART, BUCKET)
        tagged = (
            dealt.observe(noted, *sizes, *times, *seen)
            .select(*self.schema.names, PART, BUCKET)
            .sortWithinPartitions(PART, BUCKET, "active_to", *self.keys)
        )
        folder = f"{number:010d}-{uuid.uuid4().hex}"
        tagged.write.partitionBy(PART, BUCKET).parquet(self._data(folder))
        return folder, noted.get

    def _next(self, before: dict, number: int, time: int, touched: set[int], folder: str, seen: dict) -> dict:
        """The marker's body after a folder that replaces the open rows of the touched buckets."""
        parts = {b: f for b, f in before.get("open", {}).items() if int(b) not in touched}
        if seen["open_rows"]:
            # A bucket none of whose rows is open has no folder.
            parts |= {str(b): folder for b in touched if self.commits.exists(self._open_dir(b, folder))}
        closed = list(before.get("closed", []))
        if seen["closed_rows"]:
            closed.append({"folder": folder, "from": seen["first"], "to": seen["last"], "rows": seen["closed_rows"], "tier": 0})
        return {
            "time": time,
            "buckets": self.buckets,
            "open": parts,
            "closed": closed,
            **self._schema_notes(before, number),
        }

    def _commit(
        self, merged: DataFrame, number: int, before: dict, time: int, touched: set[int], source: Source | None, about: int = 0
    ) -> dict[str, int]:
        folder, seen = self._write(merged, number, *outcome_columns(), about=about)
        counts = {k: seen[k] or 0 for k in self._no_outcomes()}
        self.commits.publish(number, before, source, counts, self._next(before, number, time, touched, folder, seen))
        self._compact_soon()
        return counts

    def merge_late(
        self,
        late: DataFrame,
        at: str,
        tiebreak: Sequence[str] = (),
        log: DataFrame | None = None,
        source: Source | None = None,
        rows_per_slice: int | None = ROWS_PER_SLICE,
    ) -> dict[str, int]:
        """Takes up observations that are older than the last commit; returns rows, keys and replaced files.

        The versions of their keys are built anew from `log` (all observations of these keys, or more, without the late
        ones) and the late rows together: the table is then what it would be had all come in time. Without a log each stored
        version counts as observed when it began and when it was seen last. Of rows at one time, late ones
        come after stored ones, and by `tiebreak`.

        Open rows are replaced by bucket, closed ones by file: only files that hold a touched key are written anew, found by
        reading their key columns. Rows that are newer than the last commit are refused; `merge_log` takes those.
        The late rows are read several times; write expensive ones first.
        """
        number, body = self.state()
        done = self.commits.stored(body, source)
        if done is not None:
            return done
        place = position(F.col(at), late.schema[at].dataType)
        untimed = F.count_if(F.col(at).isNull()).alias("untimed")
        seen, touched = self._seen(late, F.max(place).alias("last"), untimed)
        if not seen["rows"]:
            return {"rows": 0, "keys": 0, "files": 0}
        if seen["untimed"]:
            raise ValueError(f"{seen['untimed']} row(s) have no {at}")
        if not body or seen["last"] > body["time"]:
            raise ValueError("row(s) newer than the last commit are not late")
        keys = list(self.keys)
        late = require_keys(late, keys)
        only = late.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in keys]).distinct()
        entries = body.get("closed", [])
        held = self._closed_rows(body, entries, "_file").join(only, keys, "left_semi")
        # A line for each file that is to be replaced.
        hit = {r[0].rpartition("/")[2] for r in held.select("_file").distinct().collect()}
        kept, replaced = [], []
        for e in entries:
            files = [f for f in self.commits.files(self._closed_dir(e)) if f.rpartition("/")[2] in hit]
            gone = {*e.get("gone", []), *[f.rpartition("/")[2] for f in files]}
            replaced.append((e["folder"], files))
            kept.append(e | {"gone": sorted(gone)} if files else e)
        old_closed = self._frame(body, replaced)
        old_open = self._open_rows(body, touched)

        kind = self.schema["active_from"].dataType
        values = [F.col(v).cast(self.schema[v].dataType).alias(v) for v in self.values]
        typed = [F.col(k).cast(self.schema[k].dataType).alias(k) for k in keys]

        def observed(rows: DataFrame, order: int) -> DataFrame:
            return rows.select(*typed, *values, F.col(at).cast(kind).alias("_at"), F.lit(order).alias("_order"), *tiebreak)

        if log is None:
            none = [F.lit(None).cast(late.schema[c].dataType).alias(c) for c in tiebreak]
            versions = old_closed.unionByName(old_open).join(only, keys, "left_semi")
            again = versions.select(
                *keys, *self.values, F.explode(F.array_distinct(F.array("active_from", "last_seen"))).alias("_at"), F.lit(0).alias("_order"), *none
            )
        else:
            # Rows of a log and late ones at one time follow their own order.
            again = observed(log, 1).join(only, keys, "left_semi")
        rebuilt = history_from_log(
            again.unionByName(observed(late, 1)), keys, self.values, "_at", ["_order", *tiebreak], self.json_cols, rows_per_slice
        )
        part = F.when(F.col("active_to").isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED)).alias(PART)
        names = self.schema.names
        others = old_closed.unionByName(old_open).join(only, keys, "left_anti")
        rows = rebuilt.select(*names, part).unionByName(others.select(*names, part))
        folder, noted = self._write(rows, number)
        after = self._next(body | {"closed": kept}, number, body["time"], touched, folder, noted)
        after["closed"] = [e for e in after["closed"] if not e.get("gone") or self._left(e)]
        outcomes = {"rows": seen["rows"], "keys": only.count(), "files": len(hit)}
        self.commits.publish(number, body, source, outcomes, after)
        return outcomes

    def _left(self, entry: dict) -> bool:
        """Has a folder files that were not replaced?"""
        return any(f.rpartition("/")[2] not in entry["gone"] for f in self.commits.files(self._closed_dir(entry)))

    def _compact_soon(self) -> None:
        if self.fanout:
            self.compact(self.fanout)

    def compact(self, fanout: int = FANOUT, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Puts the closed rows of a tier with at least `fanout` folders into one of the next tier; returns how many folders.

        The new files are ranges of the end of validity and the key, each known to the marker by the times of its rows, so an
        as-of read opens those that can hold its time. Each row is rewritten about once in a tier. Rows stay as they
        are; files no longer used stay for readers of older markers until `drop_old`.
        """
        number, body = self.state()
        tiers: dict[int, dict[str, list[dict]]] = {}
        for e in body.get("closed", []):
            tiers.setdefault(e.get("tier", 0), {}).setdefault(e["folder"], []).append(e)
        full = [t for t, folders in sorted(tiers.items()) if len(folders) >= fanout]
        if not full:
            return 0
        merged = [e for folder in tiers[full[0]].values() for e in folder]
        files = max(1, -(-sum(e["rows"] for e in merged) // rows_per_file))
        rows = self._closed_rows(body, merged)
        order = ["active_to", *self.keys]
        ranged = rows.repartitionByRange(files, *order) if files > 1 else rows.repartition(1)
        folder = f"{number:010d}-{uuid.uuid4().hex}"
        tagged = ranged.select(*self.schema.names, F.lit(CLOSED).alias(PART), F.spark_partition_id().alias(BUCKET))
        tagged.sortWithinPartitions(*order).write.partitionBy(PART, BUCKET).parquet(self._data(folder))
        kept = [e for e in body["closed"] if e.get("tier", 0) != full[0]]
        whole = {"folder": folder}
        # A line for each file of some million rows.
        stats = (
            self._frame(body | {"closed": []}, [(folder, [self._closed_dir(whole)])], "_file")
            .groupBy(F.regexp_extract("_file", f"{BUCKET}=(\\d+)", 1).cast("int").alias("part"))
            .agg(
                F.min(self._instant("active_from")).alias("from"),
                F.max(self._instant("active_to")).alias("to"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
        made = [whole | r.asDict() | {"tier": full[0] + 1} for r in stats.orderBy("part").collect()]
        self.commits.write(number, body | {"closed": kept + made})
        return len(tiers[full[0]])

    def evolve(self, *steps: Step, check: bool = True) -> HistoryStore:
        """The table with other columns, in a commit that writes no rows.

        Files written before take the steps while they are read; what is written from now on has the new columns. Keys may be
        renamed and not otherwise changed, columns of versioning not at all. With `check` a cast is tried on
        all rows first. `evolve(*[s.inverse() for s in reversed(steps)])` goes back; what a dropped column held does
        not come back. This object, and others of the old columns, then refuse to read or write; go on with the one returned.
        """
        schema, keys = self._evolved(steps, [*self.keys, *VERSIONING], check)
        renamed = {s.old: s.new for s in steps if isinstance(s, Rename)}
        json_cols = [c for c in (renamed.get(c, c) for c in self.json_cols) if c in schema.names and isinstance(schema[c].dataType, T.StringType)]
        return HistoryStore(self.spark, self.path, keys, schema, json_cols, self.buckets, self.fanout)

    def drop_old(self, keep: int = 3) -> int:
        """Deletes open rows and compacted closed rows that none of the last `keep` commits uses.

        Returns how many folders went.
        """
        bodies = [b for b in map(self.commits.read, self.commits.numbers()) if b is not None]
        parts = [{self._open_dir(*at) for at in b["open"].items()} | {self._closed_dir(e) for e in b.get("closed", [])} for b in bodies]
        unused = set().union(*parts) - set().union(*parts[-keep:])
        return sum(self.commits.delete(d) for d in sorted(unused))


# The partition of a keyed table's row: a name of its own for every combination of values.
_PARTITION = "_partition"


class KeyedStore(_Evolving):
    """A keyed table without versions, partitioned; a commit rewrites only touched partitions.

    Partitions are by columns of the key, so a row never moves. A folder's name is a hash of the values, which
    may be any text or NULL; the marker holds the values, and for every partition the folder that last wrote it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: T.StructType,
        partition_by: Sequence[str] = (),
    ):
        outside = sorted(set(partition_by) - set(keys))
        if outside:
            raise ValueError(f"a keyed table is partitioned by columns of its key, not by {outside}")
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.schema, self.partition_by = list(keys), schema, list(partition_by)
        self.commits = Commits(spark, self.path)

    @classmethod
    def of(
        cls, spark: SparkSession, root: str, spec: ResourceSpec, partition_by: Sequence[str] = ("year", "month")
    ) -> KeyedStore:
        return cls(spark, f"{root}/{spec.name}", spec.keys, spec.schema, partition_by)

    def _values(self) -> Column:
        typed = [F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.partition_by]
        return F.to_json(F.struct(*typed), {"ignoreNullFields": "false"}) if typed else F.lit("{}")

    def _dir(self, partition: str, folder: str) -> str:
        return f"{self.path}/data/{folder}/{_PARTITION}={partition}"

    def state(self) -> tuple[int, dict]:
        """The number of the next commit, and the marker that says what the table holds."""
        number, body = self.commits.last()
        return number, self._checked(body)

    def _read(self, body: dict, partitions: Mapping[str, dict]) -> DataFrame:
        return self._frame(body, [(at["folder"], [self._dir(p, at["folder"])]) for p, at in partitions.items()])

    def _all_rows(self, body: dict) -> DataFrame:
        return self._read(body, body.get("partitions", {}))

    def evolve(self, *steps: Step, check: bool = True) -> KeyedStore:
        """The table with other columns, in a commit that writes no rows; see HistoryStore.evolve.

        Columns of partitions stay as they are.
        """
        moved = sorted({s.old for s in steps if isinstance(s, Rename)} & set(self.partition_by))
        if moved:
            raise ValueError(f"{moved} partition(s) the table")
        schema, keys = self._evolved(steps, [*self.keys, "last_seen"], check)
        return KeyedStore(self.spark, self.path, keys, schema, self.partition_by)

    def rows(self, **where: object) -> DataFrame:
        """The rows; `where` names values of partition columns, and other partitions are not read."""
        unknown = sorted(set(where) - set(self.partition_by))
        if unknown:
            raise ValueError(f"{unknown} do(es) not partition {self.path}")
        body = self.state()[1]
        partitions = body.get("partitions", {})
        wanted = {p: at for p, at in partitions.items() if all(at["values"].get(c) == v for c, v in where.items())}
        return self._read(body, wanted)

    def notes(self) -> dict:
        """What earlier commits noted."""
        return self.commits.last()[1].get("notes", {})

    def change(
        self,
        batch: DataFrame,
        ts: datetime | str,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        source: Source | None = None,
        notes: Mapping[str, object] | None = None,
    ) -> dict[str, int]:
        """Replaces the partitions `batch` falls into by `combine(their rows, batch)`.

        Returns how many rows the batch brought. `notes` are kept with the commit, over those of earlier ones.
        The batch is read twice: for its partitions, of which the marker holds a line each, and for the write.
        """
        number, body = self.state()
        done = self.commits.stored(body, source)
        if done is not None:
            return done
        before = body.get("partitions", {})
        found = batch.groupBy(self._values().alias("v")).agg(F.count(F.lit(1)).alias("n"))
        found = found.select("v", "n", F.md5("v").alias("p")).collect()
        outcomes = {UPSERTED: sum(r["n"] for r in found)}
        held_notes = body.get("notes", {}) | dict(notes or {})
        if not found and held_notes == body.get("notes", {}):
            return outcomes
        partitions = dict(before)
        if found:
            held = self._read(body, {r["p"]: before[r["p"]] for r in found if r["p"] in before})
            rows = combine(held, batch).select(*self.schema.names).withColumn(_PARTITION, F.md5(self._values()))
            folder = f"{number:010d}-{uuid.uuid4().hex}"
            # Not one file per task and partition.
            rows.hint("rebalance", _PARTITION).write.partitionBy(_PARTITION).parquet(f"{self.path}/data/{folder}")
            partitions |= {r["p"]: {"folder": folder, "values": json.loads(r["v"])} for r in found}
        self.commits.publish(
            number,
            body,
            source,
            outcomes,
            {"time": micros(ts), "partitions": partitions, "notes": held_notes, **self._schema_notes(body, number)},
        )
        return outcomes

    def upsert(
        self, batch: DataFrame, ts: datetime | str, source: Source | None = None, **options
    ) -> dict[str, int]:
        """Replaces or adds whole rows by key."""
        return self.change(
            batch, ts, lambda held, new: keyed_upsert(held, new, self.keys, ts, **options), source
        )
