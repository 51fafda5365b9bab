"""Row filter, de-duplication and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.schema import field_names


def order_columns(order_by: str | Sequence[str | Column]) -> list[Column]:
    """``"a desc, b"`` or a list of names and columns as sort columns."""
    items = order_by.split(",") if isinstance(order_by, str) else order_by
    columns = []
    for item in items:
        if isinstance(item, Column):
            columns.append(item)
            continue
        name, _, way = item.strip().partition(" ")
        column = quoted(name)
        columns.append(column.desc() if way.strip().lower() == "desc" else column.asc())
    return columns


def first_per_key(
    df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str | Column]
) -> DataFrame:
    """The first row of every key under an order.

    Spark keeps one row per key in each map task before the shuffle (window group
    limit), so a key that holds much of the data reaches its reducer as one row per
    map task.
    """
    window = W.partitionBy(*[quoted(key) for key in field_names(keys)]).orderBy(
        *order_columns(order_by)
    )
    rank = "__first_per_key"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def select_rows(
    df: DataFrame,
    where: str | None = None,
    dedup: str | Sequence[str] | None = None,
    order_by: str | Sequence[str | Column] | None = None,
) -> DataFrame:
    """Filter, then drop duplicates on the listed columns.

    Which duplicate stays is open unless ``order_by`` says so.
    """
    if where and where.strip():
        df = df.filter(where)
    keys = field_names(dedup)
    if not keys:
        return df
    if order_by:
        return first_per_key(df, keys, order_by)
    return df.dropDuplicates(keys)


def redistribute(
    df: DataFrame, count: int | str | None = None, columns: str | Sequence[str] | None = None
) -> DataFrame:
    """Repartition by a count, by columns, or by both; by neither it is a no-op.

    With columns Spark sizes the partitions: it joins small ones and splits that of a
    value with much of the data. A count then is the number it starts from.
    """
    names = field_names(columns)
    if count not in (None, ""):
        return df.hint("rebalance", int(count), *names) if names else df.repartition(int(count))
    return df.hint("rebalance", *names) if names else df


def compact(
    df: DataFrame, merge: int | str = -1, partition_by: str | Sequence[str] | None = None
) -> DataFrame:
    """Set how many files a write leaves.

    ``-1`` leaves the partitions alone, a number asks for that many, and ``auto`` has
    Spark size them: small ones are joined and a large one, such as that of a
    partition value with much of the data, is split.
    """
    merge = str(merge).strip().lower()
    if merge in ("", "-1"):
        return df
    if merge == "auto":
        return df.hint("rebalance", *field_names(partition_by))
    return df.repartition(int(merge))
