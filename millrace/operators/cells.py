"""Wide rows as a table of cells, and back.

A cell table has the string columns ``row_key, family, qualifier, value``.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.buckets import range_number
from millrace.functions.text import quoted
from millrace.operators.transform import ROW_KEY
from millrace.schema import field_names

# Fixed value: the family of a column that names none.
DEFAULT_FAMILY = "cf1"


def cell_name(column: str, default_family: str = DEFAULT_FAMILY) -> tuple[str, str]:
    """``family:qualifier`` as a pair."""
    family, mark, qualifier = column.partition(":")
    if not mark:
        return default_family, family
    if not family.strip() or not qualifier.strip():
        raise ValueError(f"cell column {column!r} needs the form family:qualifier")
    return family, qualifier


def to_cells(df: DataFrame, default_family: str = DEFAULT_FAMILY) -> DataFrame:
    """One row per cell; NULL and empty values have no cell."""
    if ROW_KEY not in df.columns:
        raise ValueError(f"a wide row needs the column {ROW_KEY}")
    cells = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(qualifier).alias("qualifier"),
            quoted(name).cast("string").alias("value"),
        )
        for name in df.columns
        if name != ROW_KEY
        for family, qualifier in [cell_name(name, default_family)]
    ]
    if not cells:
        raise ValueError("a wide row needs at least one cell column")
    return df.select(
        quoted(ROW_KEY).cast("string").alias(ROW_KEY), F.inline(F.array(*cells))
    ).filter((F.col("value") != "") & F.col(ROW_KEY).isNotNull())


def row_range(bounds: str) -> tuple[str, str | None]:
    """``"start,stop"`` or ``"start"``."""
    if not bounds or not bounds.strip():
        raise ValueError("a row scan needs its bounds as start,stop")
    start, _, stop = bounds.partition(",")
    return start, stop or None


def scan_cells(
    cells: DataFrame,
    columns: str | Sequence[str],
    start: str | None = None,
    stop: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows with ``start <= row_key < stop``: the key and the chosen cells as text.

    With ``keys`` only those rows; of files with Bloom filters Spark then skips the row
    groups that hold none of them, as it skips those outside the bounds by their least and
    greatest key. A row with none of the cells is not in the result; a cell a row lacks is ``''``.
    Names match without regard to case. Bounds compare as bytes, as the keys sort.
    """
    wanted = [(*cell_name(name), name) for name in field_names(columns)]
    if not wanted:
        raise ValueError("a row scan needs the cells to read")
    if start:
        cells = cells.filter(F.col(ROW_KEY) >= start)
    if stop:
        cells = cells.filter(F.col(ROW_KEY) < stop)
    if keys:
        cells = cells.filter(F.col(ROW_KEY).isin(list(keys)))
    label = F.lower(F.concat_ws(":", "family", "qualifier"))
    labels = [f"{family}:{qualifier}".lower() for family, qualifier, _ in wanted]
    chosen = cells.select(ROW_KEY, label.alias("cell"), "value").filter(
        F.col("cell").isin(labels)
    )
    values = [
        F.coalesce(F.max(F.when(F.col("cell") == text, F.col("value"))), F.lit("")).alias(qualifier)
        for text, (_, qualifier, _) in zip(labels, wanted)
    ]
    return chosen.groupBy(ROW_KEY).agg(*values)


# Digits of the numbers that keys are told by, 0 for the end of a key.
_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"


def split_points(df: DataFrame, count: int, key: str = ROW_KEY, accuracy: int = 10_000) -> list[str]:
    """At most ``count - 1`` keys that cut the rows into about equal ranges.

    The characters after what all keys begin with are read as digits of a number, as many
    as fit into 63 bits: 18 of decimal keys, 12 of up to 35 different characters, and seven
    bytes of any others. Quantiles of it come from Spark's sketch, so what is moved is
    the sketches of map tasks. A key that holds much of the data takes several quantiles
    and is one point; its range stays larger.
    """
    text = quoted(key).cast("string")
    letters = df.select(text.alias("key"), F.explode_outer(F.array_distinct(F.split(text, ""))).alias("c"))
    low, high, used = letters.agg(F.min("key"), F.max("key"), F.collect_set("c")).first()
    if count < 2 or low is None or low == high:
        return []
    shared = os.path.commonprefix([low, high])
    used = sorted((c for c in used if c), key=str.encode)
    rest = F.substring(text, len(shared) + 1, 64)
    if len(used) < len(_DIGITS):
        base = len(used) + 1
        width = max(n for n in range(1, 64) if base**n < 1 << 63)
        digits = F.translate(F.substring(rest, 1, width), "".join(used), _DIGITS[1:base])
        number = F.conv(F.rpad(digits, width, "0"), base, 10)
    else:
        width = 7
        number = F.conv(F.rpad(F.hex(F.substring(rest.cast("binary"), 1, width)), 2 * width, "0"), 16, 10)
    shares = [i / count for i in range(1, count)]
    rows = df.where(text.isNotNull())
    found = rows.agg(F.percentile_approx(number.cast("bigint"), shares, accuracy)).first()[0]

    def point(value: int) -> str:
        if len(used) >= len(_DIGITS):
            return value.to_bytes(width, "big").rstrip(b"\0").decode(errors="ignore")
        places = [value // base**i % base for i in reversed(range(width))]
        return "".join(used[place - 1] for place in places if place)

    points = {shared + point(value) for value in found}
    return sorted((p for p in points if p.encode() > low.encode()), key=str.encode)


def range_bucket(key: Column, splits: Sequence[str]) -> Column:
    """How many split points are not above the key: 0 before the first."""
    return range_number([key < point for point in sorted(set(splits))])


def range_sorted(
    df: DataFrame,
    splits: Sequence[str],
    key: str = ROW_KEY,
    then_by: Sequence[str] = (),
    bucket: str = "range_bucket",
) -> DataFrame:
    """Rows in key order inside key ranges, for a bulk load.

    ``bucket`` numbers the range between split points. The partitions are ranges of
    (bucket, key, then_by), so a range with much of the data becomes several sorted
    partitions rather than one task.
    """
    df = df.withColumn(bucket, range_bucket(quoted(key), splits))
    order = [F.col(bucket), quoted(key), *[quoted(name) for name in then_by]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
