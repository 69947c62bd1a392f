"""Field-level differences: between two sources, between versions, against a desired state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.canonical import as_text, same


def _paired(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    return left.select(*keys, F.struct(*values).alias("_left")).join(
        right.select(*keys, F.struct(*values).alias("_right")), list(keys)
    )


def _differs(df: DataFrame, field: str, json_cols: Sequence[str]) -> Column:
    dtype = df.schema[field].dataType
    return ~same(F.col(f"_left.{field}"), F.col(f"_right.{field}"), dtype, field in json_cols)


def field_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    json_cols: Sequence[str] = (),
) -> DataFrame:
    """One row (keys, field, left, right) per differing field of the keys in both sources."""
    cells = [
        F.when(
            _differs(left, v, json_cols),
            F.struct(
                F.lit(v).alias("field"),
                as_text(F.col(f"_left.{v}"), left.schema[v].dataType).alias("left"),
                as_text(F.col(f"_right.{v}"), left.schema[v].dataType).alias("right"),
            ),
        )
        for v in values
    ]
    found = _paired(left, right, keys, values).select(
        *keys, F.explode(F.array_compact(F.array(*cells))).alias("_cell")
    )
    return found.select(*keys, "_cell.*")


def changed_fields(
    desired: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    json_cols: Sequence[str] = (),
) -> DataFrame:
    """Desired rows that differ from the current ones, with the names of the fields that do."""
    names = F.array_compact(
        F.array(*[F.when(_differs(desired, v, json_cols), F.lit(v)) for v in values])
    )
    # A generator of one row: what follows may name `changed` many times, and the optimizer would repeat the
    # comparison of all columns at every place.
    once = F.explode(F.array(F.struct(names.alias("changed")))).alias("_once")
    return (
        _paired(desired, current, keys, values)
        .select(*keys, F.col("_left.*"), once)
        .withColumn("changed", F.col("_once.changed"))
        .drop("_once")
        .where(F.size("changed") > 0)
    )


def version_churn(
    history: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    json_cols: Sequence[str] = (),
) -> DataFrame:
    """How many new versions each field caused: (field, changes).

    A version meets its successor by equality of end and start, so a key with very many versions
    spreads over all tasks.
    """
    before = history.where(F.col("active_to").isNotNull()).select(
        *keys, F.col("active_to").alias("_at"), F.struct(*values).alias("_left")
    )
    after = history.select(
        *keys, F.col("active_from").alias("_at"), F.struct(*values).alias("_right")
    )
    counts = before.join(after, [*keys, "_at"]).agg(
        *[F.count_if(_differs(history, v, json_cols)).alias(v) for v in values]
    )
    cells = [F.struct(F.lit(v).alias("field"), F.col(v).alias("changes")) for v in values]
    return (
        counts.select(F.explode(F.array(*cells)).alias("_cell"))
        .select("_cell.*")
        .where(F.col("changes") > 0)
    )
