"""Landed snapshots: JSON records as a service returned them, one folder per resource.

Every read passes the resource's schema, so nothing is inferred, unknown keys drop and a
nested object over a JSON column stays text. A record that cannot be read fails the job, unless
`mode` says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from palimpsest.spec import ResourceSpec


def _schema(spec: ResourceSpec, extra: str) -> T.StructType:
    return T.StructType(spec.raw_schema.fields + T.StructType.fromDDL(extra).fields if extra else spec.raw_schema.fields)


def read_landing(
    spark: SparkSession,
    path: str,
    spec: ResourceSpec,
    multiline: bool = False,
    mode: str = "FAILFAST",
    extra: str = "",
) -> DataFrame:
    """Raw records. `multiline` reads files that hold one JSON array each.

    `extra` declares columns the resource does not have, say the time of a snapshot.
    """
    reader = spark.read.schema(_schema(spec, extra)).option("mode", mode)
    return reader.option("multiLine", multiline).json(path)


def stream_landing(
    spark: SparkSession,
    path: str,
    spec: ResourceSpec,
    files_per_batch: int | None = None,
    mode: str = "FAILFAST",
    extra: str = "",
) -> DataFrame:
    """Raw records as they land."""
    reader = spark.readStream.schema(_schema(spec, extra)).option("mode", mode)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)
