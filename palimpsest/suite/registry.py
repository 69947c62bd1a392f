from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palimpsest.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL for its rows."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table a query writes."""
    return f"{shared_dir(spark)}/palimpsest/{name}-{uuid.uuid4().hex}"
