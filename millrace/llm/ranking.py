"""The best rows of each group, however many of the rows one group holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def best_rows(df: DataFrame, group: str, order: list[Column], spread: Column, most: int, rank: str) -> DataFrame:
    """The first ``most`` rows of every group in ``order``, numbered from 1 in the column ``rank``.

    A group is ranked in slices by the hash of ``spread`` first, and only the best of each
    slice meet in one task, so that task holds ``most`` times ``SLICES`` rows at most.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(SLICES)))
    for keys in ([group, "_slice"], [group]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        sliced = sliced.withColumn(rank, place).where(F.col(rank) <= most)
    return sliced.drop("_slice")
