"""Raw records to typed rows, and typed rows to raw payloads."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.canonical import json_text, json_value
from palimpsest.functions.casing import camel, snake
from palimpsest.spec import Field, ResourceSpec


def explode_children(
    df: DataFrame, children: str, parent: Sequence[str], position: str | None = None
) -> DataFrame:
    """One row per child record, with the parent's columns; no children, no rows.

    `position` adds the child's 0-based index under that name.
    """
    if position:
        out = df.select(*parent, F.posexplode(children).alias(position, "_child"))
        return out.select(*parent, position, "_child.*")
    out = df.select(*parent, F.explode(children).alias("_child"))
    return out.select(*parent, "_child.*")


def rename_raw(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Raw names to column names: the override if there is one, else snake_case."""
    overrides = overrides or {}
    return df.select(*[F.col(f"`{c}`").alias(overrides.get(c) or snake(c)) for c in df.columns])


def _typed(col: Column, have: T.DataType, want: Field, strict: bool) -> Column:
    if want.kind == "json":
        if isinstance(have, T.StringType):
            return json_text(col)
        if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
            return json_text(F.to_json(col, {"ignoreNullFields": "false"}))
        # A scalar is written as the only element of an array, whose brackets go.
        return F.when(col.isNotNull(), json_text(F.regexp_replace(F.to_json(F.array(col)), r"^\[|\]$", "")))
    if want.kind == "array" and isinstance(have, T.StringType):
        parsed = F.from_json(col, want.dtype)
        if not strict:
            return parsed
        unread = parsed.isNull() & col.isNotNull() & ~F.lower(F.trim(col)).isin("", "null")
        failed = F.raise_error(F.lit(f"{want.name} is not a JSON array")).cast(want.dtype)
        return F.when(unread, failed).otherwise(parsed)
    return col.cast(want.dtype) if strict else col.try_cast(want.dtype)


def normalize(
    df: DataFrame, spec: ResourceSpec, strict: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw records to the declared columns: unknown ones drop, missing ones are NULL.

    `strict` fails on a value that does not fit its type and on a NULL in a required column; otherwise it
    becomes NULL. NULL keys are left to the merge, which names them. Columns in `keep` go along as they are.
    """
    if spec.children and spec.children in df.columns:
        here = [c for c in df.columns if c != spec.children]
        df = explode_children(df, spec.children, here, spec.position)
    declared = set(spec.columns)
    source: dict[str, str] = {}
    for raw in df.columns:
        name = spec.overrides.get(raw) or snake(raw)
        # The override wins over a raw name that happens to spell the column.
        if name in declared and (name not in source or raw in spec.overrides):
            source[name] = raw
    missing = [c for c in spec.required if c not in source and c not in spec.flatten and c not in ("month", "year")]
    if missing:
        raise ValueError(f"{spec.name}: required column(s) missing: {missing}")
    columns = []
    for f in spec.fields:
        have = None
        if f.name in source:
            raw = source[f.name]
            have = _typed(F.col(f"`{raw}`"), df.schema[raw].dataType, f, strict)
        path = spec.flatten.get(f.name)
        if path:
            outer, inner = path.split(".")
            shape = df.schema[outer].dataType if outer in df.columns else None
            if isinstance(shape, T.StructType) and inner in shape.names:
                nested = F.col(f"{outer}.{inner}").cast(f.dtype)
                have = nested if have is None else F.coalesce(have, nested)
        if strict and have is not None and f.required and f.name not in spec.keys:
            lacking = F.raise_error(F.lit(f"{spec.name}: {f.name} is required and NULL")).cast(f.dtype)
            have = F.coalesce(have, lacking)
        columns.append((F.lit(None).cast(f.dtype) if have is None else have).alias(f.name))
    return df.select(*columns, *keep)


def business_columns(df: DataFrame, spec: ResourceSpec) -> DataFrame:
    return df.select(*spec.values)


def declared_columns(df: DataFrame, spec: ResourceSpec) -> DataFrame:
    """The declared columns with versioning; anything else a stored table has is dropped."""
    return df.select(*spec.schema.names)


def payload(
    fields: Sequence[tuple[str, str, bool]], only: Column | None = None
) -> Column:
    """A JSON object text from columns (column, name in the object, whether it is JSON text).

    NULLs stay as `null`. `only`, an array of column names, limits a row to those fields.
    """
    pairs = []
    for column, name, is_json in fields:
        pair = F.concat(F.lit(f'"{name}":'), json_value(F.col(column), is_json))
        pairs.append(pair if only is None else F.when(F.array_contains(only, column), pair))
    body = F.array_join(F.array_compact(F.array(*pairs)), ",")
    return F.concat(F.lit("{"), body, F.lit("}"))


def payload_fields(
    spec: ResourceSpec, only: Sequence[str] | None = None, sensitive: bool = False
) -> list[tuple[str, str, bool]]:
    """The payload fields of a resource; secrets only where asked for."""
    return [
        (f.name, f.raw_name, f.kind == "json")
        for f in spec.fields
        if (only is None or f.name in only) and (sensitive or not f.sensitive)
    ]


def to_payload(
    df: DataFrame, spec: ResourceSpec, only: Sequence[str] | None = None, sensitive: bool = False
) -> DataFrame:
    """`df` with `payload`, the row as a camelCase JSON object without versioning columns."""
    return df.withColumn("payload", payload(payload_fields(spec, only, sensitive)))


def path(template: str) -> Column:
    """A path per row from a template with {column} places."""
    places = re.findall(r"{(\w+)}", template)
    return F.format_string(re.sub(r"{\w+}", "%s", template), *[F.col(p).cast("string") for p in places])


def with_resource_path(df: DataFrame, spec: ResourceSpec) -> DataFrame:
    return df.withColumn("resource_path", path(spec.path))


def camel_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(camel(c)) for c in df.columns])
