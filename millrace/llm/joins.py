"""Joins with a side that may or may not be small, and the files that finished ones leave."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its rows, which have been counted, are few; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def release(spark: SparkSession) -> None:
    """Let go of finished queries, upon which Spark deletes their shuffle files.

    Between steps that each write their result, so that disk holds one step's shuffles at
    a time; Spark does so by itself only when the driver happens to run short of memory.
    """
    spark.range(1).collect()  # the session holds on to its last query
    gc.collect()
    spark.sparkContext._jvm.System.gc()
