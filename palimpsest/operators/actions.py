"""Write-back records and their batches. Nothing is sent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.convert import path, payload, payload_fields
from palimpsest.operators.diff import changed_fields
from palimpsest.operators.slices import (
    ROWS_PER_SLICE,
    SLICE,
    by_slice,
    in_slice,
    sliced,
    summarise,
)
from palimpsest.spec import ResourceSpec

# How many actions one batch may hold.
ASYNC_LIMIT = 100
SYNC_LIMIT = 20


def action(resource: Column, operation: Column, body: Column | None = None) -> Column:
    """An action record; an empty resource or operation fails at run time.

    `body` is JSON object text; anything else fails.
    """

    def filled(col: Column, name: str) -> Column:
        empty = col.isNull() | (col == "")
        return F.when(empty, F.raise_error(F.lit(f"an action needs its {name}"))).otherwise(col)

    text = F.lit(None).cast("string") if body is None else body
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))
    checked = F.when(text.isNull() | is_object, text).otherwise(
        F.raise_error(F.lit("body must be a JSON object"))
    )
    return F.struct(
        filled(resource, "resource").alias("resource"),
        filled(operation, "operation").alias("operation"),
        checked.alias("body"),
    )


def update_actions(
    desired: DataFrame, current: DataFrame, spec: ResourceSpec, sensitive: bool = False
) -> DataFrame:
    """One update action per row whose desired state differs, carrying only the changed fields."""
    values = spec.shown(sensitive)
    changed = changed_fields(desired, current, spec.keys, values, spec.json_cols)
    fields = payload_fields(spec, values, sensitive)
    body = payload(fields, only=F.col("changed"))
    return changed.select(
        *spec.keys, "changed", action(path(spec.path), F.lit("update"), body).alias("action")
    )


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """0-based position of each row in its group.

    `order` must be unique within the group; its columns may be of any type that can be ordered.
    """
    rows, slicing = sliced(df, by, order, rows_per_slice)
    local = F.row_number().over(in_slice(by, *order)) - 1
    if not slicing:
        return rows.withColumn(name, local.cast("bigint")).select(*df.columns, name)
    sizes = summarise(rows, by, F.count(F.lit(1)).alias("_rows"))
    before = by_slice(by).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, SLICE, F.sum("_rows").over(before).alias("_start"))
    placed = rows.withColumn("_local", local).join(starts, [*by, SLICE], "left")
    total = F.col("_local") + F.coalesce(F.col("_start"), F.lit(0))
    return placed.withColumn(name, total.cast("bigint")).select(*df.columns, name)


def chunk_actions(
    actions: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    synchronous: bool = False,
    column: str = "action",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Batches of at most ASYNC_LIMIT (or SYNC_LIMIT) actions per group, in order."""
    size = SYNC_LIMIT if synchronous else ASYNC_LIMIT
    numbered = number_rows(actions, by, order, "_position", rows_per_slice)
    chunk = F.floor(F.col("_position") / size).cast("bigint")
    gathered = F.sort_array(F.collect_list(F.struct("_position", F.col(column).alias("_action"))))
    return (
        numbered.groupBy(*by, chunk.alias("chunk"))
        .agg(gathered.alias("_sorted"))
        .select(*by, "chunk", F.transform("_sorted", lambda s: s["_action"]).alias("actions"))
    )
