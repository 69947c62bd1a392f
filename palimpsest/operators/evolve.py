"""Schema evolution as table transformations, each with its inverse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.canonical import json_text
from palimpsest.spec import ResourceSpec


@dataclass(frozen=True)
class Rename:
    """Renames a column; nothing happens where the old name is absent."""

    old: str
    new: str

    def apply(self, df: DataFrame) -> DataFrame:
        if self.old in df.columns and self.new in df.columns:
            raise ValueError(f"cannot rename {self.old}: {self.new} exists")
        return df.withColumnRenamed(self.old, self.new)

    def inverse(self) -> Rename:
        return Rename(self.new, self.old)


@dataclass(frozen=True)
class Cast:
    """Changes a type. JSON text becomes an array, and back; a bad value fails."""

    column: str
    to: str
    back: str = "string"

    def apply(self, df: DataFrame) -> DataFrame:
        have = df.schema[self.column].dataType
        want = df.limit(0).select(F.lit(None).cast(self.to).alias("c")).schema["c"].dataType
        col = F.col(self.column)
        if isinstance(have, T.StringType) and isinstance(want, (T.ArrayType, T.StructType, T.MapType)):
            new = F.from_json(col, want, {"mode": "FAILFAST"})
        elif isinstance(want, T.StringType) and isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
            new = json_text(F.to_json(col, {"ignoreNullFields": "false"}))
        else:
            new = col.cast(want)
        return df.withColumn(self.column, new)

    def inverse(self) -> Cast:
        return Cast(self.column, self.back, self.to)


@dataclass(frozen=True)
class Add:
    """Adds a NULL column unless it exists."""

    column: str
    type: str = "string"

    def apply(self, df: DataFrame) -> DataFrame:
        if self.column in df.columns:
            return df
        return df.withColumn(self.column, F.lit(None).cast(self.type))

    def inverse(self) -> Drop:
        return Drop(self.column, self.type)


@dataclass(frozen=True)
class Drop:
    """Drops a column if it is there. The inverse brings the column back, not its values."""

    column: str
    type: str = "string"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.drop(self.column)

    def inverse(self) -> Add:
        return Add(self.column, self.type)


Step = Rename | Cast | Add | Drop


def step_to_dict(step: Step) -> dict:
    return {"step": type(step).__name__, **asdict(step)}


def step_from_dict(fields: dict) -> Step:
    kinds = {kind.__name__: kind for kind in (Rename, Cast, Add, Drop)}
    return kinds[fields["step"]](**{k: v for k, v in fields.items() if k != "step"})


def upgrade(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for step in steps:
        df = step.apply(df)
    return df


def downgrade(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for step in reversed(steps):
        df = step.inverse().apply(df)
    return df


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to the optimizer as such."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns).where(F.lit(False))


def empty_table(spark: SparkSession, spec: ResourceSpec) -> DataFrame:
    """A resource's table before its first commit."""
    return empty_frame(spark, spec.schema)
