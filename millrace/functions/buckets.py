"""Which of some ascending ranges a row falls into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_number(below: Sequence[Column], first: int = 0) -> Column:
    """How many ascending points the row is not below; ``below[i]`` compares with point ``i``.

    The comparisons form a balanced tree of conditions, so a row meets few of them and
    all stay in generated code. A row that cannot be compared falls into the last range.
    """
    if not below:
        return F.lit(first)
    middle = len(below) // 2
    return F.when(below[middle], range_number(below[:middle], first)).otherwise(
        range_number(below[middle + 1 :], first + middle + 1)
    )
