"""Streams into the tables. Each micro-batch is one commit, which remembers the stream and the batch's number:
a batch delivered twice counts once, and a stream follows on whatever the table holds. All queries run what
is there and stop (`availableNow`)."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palimpsest.functions.times import moment
from palimpsest.operators.counters import LOOKBACK, accumulate, monthly_delta, split_late
from palimpsest.sources.store import Commits, HistoryStore, KeyedStore, Source


def _run(
    stream: DataFrame, commits: Commits, each: Callable[[DataFrame, Source], None], checkpoint: str
) -> StreamingQuery:
    def numbered(batch: DataFrame, number: int) -> None:
        # Spark names a stream by its checkpoint; a new checkpoint is a new stream.
        name = json.loads(commits.text(f"{checkpoint}/metadata"))["id"]
        each(batch, (f"stream {name}", number))

    writer = stream.writeStream.foreachBatch(numbered).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_log(
    stream: DataFrame, store: HistoryStore, at: str, tiebreak: Sequence[str] = (), checkpoint: str | None = None
) -> StreamingQuery:
    """Observations with their own times; a batch may hold many per key. Batches come in time
    order: one older than the last commit stops the query, and so does a row without a time."""

    def each(batch: DataFrame, source: Source) -> None:
        store.merge_log(batch, at, tiebreak, source=source)

    return _run(stream, store.commits, each, checkpoint or f"{store.path}/stream")


def stream_snapshots(
    stream: DataFrame,
    store: HistoryStore,
    clock: Callable[[int], datetime | str],
    checkpoint: str | None = None,
    **options,
) -> StreamingQuery:
    """Snapshots without a time of their own; `clock` gives each batch number its time."""

    def each(batch: DataFrame, source: Source) -> None:
        store.merge(batch, clock(source[1]), source=source, **options)

    return _run(stream, store.commits, each, checkpoint or f"{store.path}/stream")


def late_events(store: KeyedStore, like: DataFrame) -> DataFrame:
    """The events that `stream_counters` set aside, with the columns of `like`."""
    path = f"{store.path}/late"
    if not store.commits.exists(path):
        return like.limit(0)
    reader = like.sparkSession.read.schema(like.schema).option("recursiveFileLookup", True)
    return reader.parquet(path)


def without_repeats(
    stream: DataFrame, at: str, once_by: Sequence[str], now: datetime | str, lookback: str = LOOKBACK
) -> DataFrame:
    """A stream without the repeats of events that are not late; late and untimed events go through as they are.

    The watermark follows the events' time, but never passes `now`: it stays `lookback` behind that at least, so no event
    that can still be counted is dropped for its age. A NULL in `once_by` equals NULL.
    """
    marked = split_late(stream, at, now, lookback)
    limit = moment(now, stream.schema[at].dataType).cast("timestamp")
    clock = F.least(F.col(at).cast("timestamp"), limit)
    timely = marked.where(~F.col("late")).withColumn("_clock", clock).withWatermark("_clock", lookback)
    once = timely.dropDuplicatesWithinWatermark(list(once_by)).select(*stream.columns)
    return once.unionByName(marked.where("late").select(*stream.columns))


def stream_counters(
    stream: DataFrame,
    store: KeyedStore,
    measures: Sequence[str],
    at: str,
    now: datetime | str,
    lookback: str = LOOKBACK,
    late: Callable[[DataFrame, int], None] | None = None,
    checkpoint: str | None = None,
    once_by: Sequence[str] = (),
) -> StreamingQuery:
    """Usage events added to the monthly counters.

    `once_by` names the columns that tell an event: one that comes again, in the same batch or a later one, counts once. Spark's
    state store remembers events for `lookback` of event time; older ones are late and not counted anyway.

    Events older than `lookback` before `now`, and those without a time, are not counted. They go to `late`, or else
    to a folder of the table, where `late_events` finds them.
    """
    keys = [k for k in store.keys if k not in ("month", "year")]
    if once_by:
        stream = without_repeats(stream, at, once_by, now, lookback)

    def each(batch: DataFrame, source: Source) -> None:
        marked = split_late(batch, at, now, lookback)
        aside = marked.where("late").drop("late")
        if late is not None:
            late(aside, source[1])
        else:
            # Under the batch's name: written again, it replaces itself.
            folder = f"{store.path}/late/{source[0].replace(' ', '-')}-{source[1]}"
            aside.write.mode("overwrite").parquet(folder)
        timely = marked.where(~F.col("late")).withColumn("last_seen", F.col(at).cast("timestamp"))
        delta = monthly_delta(timely, keys, measures, at)
        store.change(delta, now, lambda held, new: accumulate(held, new, store.keys, measures), source)

    return _run(stream, store.commits, each, checkpoint or f"{store.path}/stream")
