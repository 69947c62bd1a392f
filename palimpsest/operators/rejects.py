"""Records that do not convert, kept apart with the reasons, in the pass that converts all others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.operators.convert import normalize
from palimpsest.spec import ResourceSpec

# The text of a record that is no JSON object at all.
CORRUPT = "_corrupt_record"
ERRORS = "_errors"
RECORD = "_record"

# The reasons.
UNREADABLE, MISSING, UNFIT = "unreadable", "missing", "does not fit"


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with text for every value."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            return T.ArrayType(_as_text(kind.elementType))
        return T.StringType()  # the array's own text
    return T.StringType()


def read_lenient(spark: SparkSession, path: str, spec: ResourceSpec) -> DataFrame:
    """Landed records with every value as text, so that none is lost to its type; CORRUPT holds lines that are no object."""
    schema = T.StructType([*_as_text(spec.raw_schema).fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def checked(raw: DataFrame, spec: ResourceSpec) -> DataFrame:
    """All records of `read_lenient` as the declared columns, RECORD (their text) and ERRORS: field, value, reason for each fault.

    A fault is a value that does not fit its column, a NULL in a required column or a key, or an unreadable record. Nested
    children are records of their own; a parent without children has none.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    whole = [c for c in raw.columns if c != CORRUPT]
    # A record that cannot be read is kept through the explode of children as one empty child.
    held = raw.withColumn(RECORD, F.coalesce(corrupt, F.to_json(F.struct(*whole))))
    held = held.withColumn("_unread", corrupt.isNotNull())
    if spec.children and spec.children in raw.columns:
        child = raw.schema[spec.children].dataType.elementType
        one = F.array(F.lit(None).cast(child))
        held = held.withColumn(spec.children, F.when(F.col("_unread"), one).otherwise(F.col(spec.children)))
    held = held.drop(CORRUPT)
    text = ResourceSpec(
        spec.name, spec.keys, tuple(_texts(spec)), spec.path, spec.versioned, spec.children, spec.parent, spec.position, spec.flatten
    )
    given = normalize(held, text, strict=False, keep=[RECORD, "_unread"])
    names = [f.name for f in spec.fields]

    def judged(r: Column) -> Column:
        columns, faults = [], []
        for f in spec.fields:
            value = r[f.name]
            if f.kind in ("json", "string"):
                typed = value
            elif f.kind == "array":
                typed = F.from_json(value, f.dtype)
            else:
                typed = value.try_cast(f.dtype)
            columns.append(typed.alias(f.name))
            if f.kind not in ("json", "string"):
                unfit = value.isNotNull() & typed.isNull()
                if f.kind == "array":
                    unfit = unfit & ~F.lower(F.trim(value)).isin("", "null")
                faults.append(F.when(unfit, _fault(f.name, value.cast("string"), f"{UNFIT} {f.kind}")))
            if f.required or f.name in spec.keys:
                faults.append(F.when(value.isNull(), _fault(f.name, F.lit(None).cast("string"), MISSING)))
        unread = F.array(_fault(None, F.lit(None).cast("string"), UNREADABLE))
        errors = F.when(r["_unread"], unread).otherwise(F.array_compact(F.array(*faults)))
        return F.struct(*columns, errors.alias(ERRORS))

    # One value for the whole row, judged once: a column for each field and fault would have the optimizer weigh
    # what each says of all the others.
    row = F.get(F.transform(F.array(F.struct(*names, "_unread")), judged), 0)
    return given.select(row.alias("_row"), RECORD).select("_row.*", RECORD)


def _texts(spec: ResourceSpec):
    from dataclasses import replace

    for f in spec.fields:
        yield f if f.kind == "json" or f.name == spec.position else replace(f, kind="string", raw_kind="string")


def _fault(field: str | None, value, reason: str):
    return F.struct(F.lit(field).cast("string").alias("field"), value.alias("value"), F.lit(reason).alias("reason"))


def accepted(rows: DataFrame) -> DataFrame:
    """Records without a fault, as typed rows."""
    return rows.where(F.size(ERRORS) == 0).drop(RECORD, ERRORS)


def rejected(rows: DataFrame) -> DataFrame:
    """field, value, reason and record, a row for each fault."""
    return rows.select(F.explode(ERRORS).alias("_e"), F.col(RECORD).alias("record")).select("_e.*", "record")
