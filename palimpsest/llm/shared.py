"""What the operators share: cutting lineage, fixed-size bitmaps of hashes, reading tables."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import shared_dir


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


# Rows for which a task is worth its start.
ROWS_PER_TASK = 16_384


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """The frame in no more tasks than about `rows` rows keep busy, and the cores; nothing is shuffled for it.

    For steps whose rows are known before they run: many near-empty tasks cost their start, a file and a worker each.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)))


def cut(df: DataFrame, *done: DataFrame) -> DataFrame:
    """The rows, written to the shared folder as compressed Parquet and read from there.

    `done` are frames this function returned before that nothing reads any more: their files are deleted.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/palimpsest/step-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.step_path = path
    forget(*done)
    return out


def forget(*done: DataFrame) -> None:
    """Deletes the files of frames that `cut` returned and nothing reads any more."""
    for frame in done:
        spark = frame.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(frame.step_path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bitmap(hashes: DataFrame, column: str, log2: int) -> np.ndarray:
    """A bitmap of 2**log2 bits with the bit of every hash (its highest bits) set.

    Its size is fixed, whatever the number of hashes: at most 2**log2 / 32 rows reach the driver.
    A filter by it loses nothing; what it lets through by chance is for the caller's join to refuse.
    """
    place = F.shiftrightunsigned(F.col(column), 64 - log2)
    cells = (
        hashes.where(F.col(column).isNotNull())
        .groupBy((place / 32).cast("int").alias("cell"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int"))).alias("bits"))
    )
    found = cells.toPandas()
    out = np.zeros(1 << (log2 - 5), np.uint32)
    out[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) have their bit set."""
    log2 = len(bits).bit_length() - 1 + 5
    place = hashes >> np.uint64(64 - log2)
    return (bits[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0
