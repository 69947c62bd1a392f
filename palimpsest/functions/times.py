"""Time literals that keep the type of the column they meet."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Moment = datetime | str | Column


def moment(value: Moment, dtype: T.DataType | None = None) -> Column:
    """A time literal of type `dtype` (default TIMESTAMP).

    Times without a zone are UTC. The result does not depend on the session zone.
    """
    dtype = dtype or T.TimestampType()
    if isinstance(value, Column):
        return value.cast(dtype)
    parsed = datetime.fromisoformat(value) if isinstance(value, str) else value
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc).replace(tzinfo=None)
    text = parsed.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        text += "+00:00"
    return F.lit(text).cast(dtype)


def utc_date(col: Column, dtype: T.DataType) -> Column:
    """The day of a time in UTC, whatever the session zone."""
    if isinstance(dtype, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_seconds(col) / 86400).cast("int"))
    return F.to_date(col)


def midnight(day: Column, dtype: T.DataType) -> Column:
    """The first moment of a day in UTC, as a time of type `dtype`."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400)
    return day.cast(dtype)


def position(col: Column, dtype: T.DataType) -> Column:
    """A whole number that never falls when `col` rises; microseconds for times.

    Times without zone are counted from their own calendar fields, since a cast
    through the session zone can run backwards where clocks are put forward.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date")).cast("bigint")
        seconds = F.hour(col) * 3600 + F.minute(col) * 60 + F.extract(F.lit("SECOND"), col)
        return days * 86_400_000_000 + (seconds * 1_000_000).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(dtype, T.NumericType):
        return F.floor(col).cast("bigint")
    raise TypeError(f"cannot slice by a column of type {dtype.simpleString()}")
