"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # A commit writes open and closed rows to two folders; with writers for both at once its
    # rows need no sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


# Adaptive execution merges small shuffle partitions but does not add any, so their first number
# must suit the largest shuffle: about this many bytes each.
PARTITION_BYTES = 256 * 2**20


def shuffle_partitions(input_bytes: int) -> int:
    """How many shuffle partitions a job over `input_bytes` should start from."""
    return max(input_bytes // PARTITION_BYTES, 200)


def session(
    app: str = "palimpsest",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the defaults; `conf` uses `__` for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        first = str(shuffle_partitions(input_bytes))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", first)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local run without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="palimpsest-")
    return _OWN_DIRS[app]


def step_path(spark: SparkSession) -> str:
    """A fresh folder for rows between two steps of a job."""
    return f"{shared_dir(spark)}/palimpsest/step-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read from there: computed once, and the same wherever a plan reads them."""
    path = path or step_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
