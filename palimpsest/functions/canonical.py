"""One comparable form per value, and null-safe equality on it.

Two values are the same business value when their canonical forms are equal:

* JSON text: object keys sorted at every depth, list order kept, spacing gone; text that
  is not JSON stands for itself. Only columns declared as JSON are parsed, so the
  plain text '443' never turns into a number.
* Arrays and maps compare by value. An empty list or object equals NULL, at top level only.
* Everything else compares as it is.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPTY_JSON = ("[]", "{}", "null")


def json_text(col: Column) -> Column:
    """JSON text with sorted keys and no spacing; other text unchanged."""
    return F.coalesce(F.to_json(F.try_parse_json(col)), col)


def json_canonical(col: Column) -> Column:
    text = json_text(col)
    return F.when(~text.isin(*EMPTY_JSON), text)


def comparable(col: Column, dtype: T.DataType, is_json: bool = False) -> Column:
    if is_json:
        return json_canonical(col)
    if isinstance(dtype, T.ArrayType):
        return F.when(F.size(col) > 0, col)
    if isinstance(dtype, T.MapType):
        return F.when(F.size(col) > 0, F.array_sort(F.map_entries(col)))
    return col


def same(left: Column, right: Column, dtype: T.DataType, is_json: bool = False) -> Column:
    """Null-safe equality of two values of one column."""
    if is_json:
        # Equal text needs no parsing, and most rows of a snapshot are unchanged.
        return left.eqNullSafe(right) | json_canonical(left).eqNullSafe(json_canonical(right))
    return comparable(left, dtype).eqNullSafe(comparable(right, dtype))


def same_row(
    df: DataFrame,
    values: Iterable[str],
    left: str,
    right: str,
    json_cols: Iterable[str] = (),
    types: DataFrame | None = None,
) -> Column:
    """Whether the structs `left` and `right` of `df` agree on all `values`."""
    schema = (types or df).schema
    tests = [
        same(F.col(f"{left}.{c}"), F.col(f"{right}.{c}"), schema[c].dataType, c in set(json_cols))
        for c in values
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def json_value(col: Column, is_json: bool = False) -> Column:
    """The column as a JSON value in text; NULL becomes `null`."""
    if is_json:
        return F.coalesce(col, F.lit("null"))
    wrapped = F.to_json(F.array(col), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def as_text(col: Column, dtype: T.DataType) -> Column:
    """The column as text for reports on values of mixed types."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")
