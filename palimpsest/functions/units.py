"""Unit conversion for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: bytes in a gigabyte.
GIGABYTE = 1_073_741_824


def gigabytes(bytes_: Column, digits: int = 2) -> Column:
    """Bytes as gigabytes, rounded half up; NULL stays NULL."""
    return F.round(bytes_.cast("decimal(20,0)") / F.lit(GIGABYTE).cast("decimal(20,0)"), digits)
