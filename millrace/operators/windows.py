"""Per-group counts, ranks and running values that hold when one group is huge.

A plain window puts all rows of a group into one task. Here group counts are
aggregated before they are joined back, ranks are limited before the shuffle, and
running values work on ranges of (group, order) that are written once, so building
one starts jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import quoted
from millrace.operators.rows import order_columns
from millrace.schema import field_names
from millrace.session import written

_KEY = "__key"
_RANGE = "__range"
_SLICE = "__slice"

# Spark cuts a ranked window before the shuffle up to this limit; above, groups are ranked
# in so many slices first.
SPARK_LIMIT = 1000
SLICES = 256

# About how many rows a range of a running value holds.
ROWS_PER_RANGE = 1_000_000
_RESERVED = (_KEY, _RANGE, "__part", "__before", "__inside", "__carried", "__next")


def _group_key(keys: str | Sequence[str]) -> Column:
    """The keys as one struct, in which a NULL equals a NULL when groups are joined."""
    return F.struct(*[quoted(key) for key in field_names(keys)])


def with_group_count(
    df: DataFrame, keys: str | Sequence[str], column: str, name: str = "group_count"
) -> DataFrame:
    """Add the number of non-NULL values of ``column`` in the row's group.

    The counts are combined on the map side; the join back is one Spark may broadcast,
    or split where a key is skewed.
    """
    rows = df.withColumn(_KEY, _group_key(keys))
    counts = rows.groupBy(_KEY).agg(F.count(quoted(column)).alias(name))
    return rows.join(counts, _KEY, "left").drop(_KEY)


def top_per_group(
    df: DataFrame, keys: str | Sequence[str], order_by, limit: int, name: str = "rank"
) -> DataFrame:
    """Rows whose rank in their group is at most ``limit``; ties share a rank.

    Up to ``SPARK_LIMIT`` Spark drops what ranks lower in its map task before the shuffle.
    Above, a group is ranked in ``SLICES`` slices by the hash of its rows first: a row that
    ranks beyond the limit in its slice does so in the group, and what is left of a hot
    group, ties aside, is ``limit`` rows per slice.
    """
    taken = [column for column in df.columns if column.lower() in (name.lower(), _SLICE)]
    if taken:
        raise ValueError(f"columns {taken} are there already; give the rank another name")
    groups, order = [quoted(key) for key in field_names(keys)], order_columns(order_by)

    def cut(rows: DataFrame, parts: list[Column]) -> DataFrame:
        ranked = rows.withColumn(name, F.rank().over(W.partitionBy(*parts).orderBy(*order)))
        return ranked.filter(F.col(name) <= limit)

    if limit > SPARK_LIMIT:
        whole = F.to_json(F.struct("*")) if any(_unhashable(f.dataType) for f in df.schema) else F.struct("*")
        sliced = df.withColumn(_SLICE, F.pmod(F.xxhash64(whole), F.lit(SLICES)))
        df = cut(sliced, [*groups, F.col(_SLICE)]).drop(name, _SLICE)
    return cut(df, groups)


def _unhashable(kind: T.DataType) -> bool:
    """Whether a type holds a map, which Spark does not hash."""
    return "map<" in kind.simpleString()


def _in_ranges(df: DataFrame, keys: str | Sequence[str], order_by) -> DataFrame:
    """The rows with their group key and the number of their range of (group, order).

    There are as many ranges as the rows need, so a large group spans several, and within
    a group the number grows along the order. The input is evaluated once, by a write;
    counting its rows reads file footers, and sampling for the ranges reads the key and
    order columns of the files. The ranges are written too: every later step must see the
    same ones. Rows that fit into one range stay as they are.
    """
    taken = [name for name in df.columns if name.lower() in _RESERVED]
    if taken:
        raise ValueError(f"columns {taken} are reserved for running values")
    rows = written(df.withColumn(_KEY, _group_key(keys)), "rows")
    count = -(-rows.count() // ROWS_PER_RANGE)
    if count <= 1:
        return rows.withColumn(_RANGE, F.lit(0))
    spread = rows.repartitionByRange(count, F.col(_KEY), *order_columns(order_by))
    return written(spread.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _within(order_by, *groups: str) -> WindowSpec:
    return W.partitionBy(*groups).orderBy(*order_columns(order_by))


def running_total(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by,
    value: str,
    name: str = "running_total",
) -> DataFrame:
    """Sum of ``value`` over the group's rows up to and including this one.

    ``order_by`` takes what ``order_columns`` takes and orders the rows of a group fully.
    Ranges are summed apart, and each starts from the sum of the ranges before it. The
    result has the type of a plain sum.
    """
    rows = _in_ranges(df, keys, order_by)
    amount, so_far = F.sum(quoted(value)), (W.unboundedPreceding, W.currentRow)
    kind = df.select(amount.alias("sum")).schema["sum"].dataType
    earlier = W.partitionBy(_KEY).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    before = (
        rows.groupBy(_KEY, _RANGE)
        .agg(amount.alias("__sum"))
        .select(_KEY, _RANGE, F.sum("__sum").over(earlier).alias("__before"))
    )
    part = amount.over(_within(order_by, _KEY, _RANGE).rowsBetween(*so_far))
    total = F.coalesce(F.col("__part") + F.col("__before"), F.col("__part"), F.col("__before"))
    return (
        rows.withColumn("__part", part)
        .join(before, [_KEY, _RANGE], "left")
        .withColumn(name, total.cast(kind))
        .drop(_KEY, _RANGE, "__part", "__before")
    )


def previous_value(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by,
    value: str,
    name: str = "previous_value",
) -> DataFrame:
    """``value`` of the group's row before this one, NULL for the first.

    The order and the ranges are as for ``running_total``. The first row of a range takes
    the last value of the nearest range before it.
    """
    rows = _in_ranges(df, keys, order_by)
    boxed = F.struct(quoted(value).alias("v"))
    after = F.lead(F.lit(1)).over(_within(order_by, _KEY, _RANGE))
    last = rows.withColumn("__next", after).where("__next is null").select(_KEY, _RANGE, boxed.alias("__last"))
    carried = last.select(
        _KEY, _RANGE, F.lag("__last").over(_within([_RANGE], _KEY)).alias("__carried")
    )
    return (
        rows.withColumn("__inside", F.lag(boxed).over(_within(order_by, _KEY, _RANGE)))
        .join(carried, [_KEY, _RANGE], "left")
        .withColumn(name, F.coalesce("__inside", "__carried")["v"])
        .drop(_KEY, _RANGE, "__inside", "__carried")
    )
