"""Window operators against plain windows, with a key that holds a third of the rows."""

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.windows import previous_value, running_total, top_per_group, with_group_count


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(3000).selectExpr(
        "id",
        "case when id % 3 = 0 then 0 when id % 50 = 1 then null else id % 40 end as k",
        "cast(if(id % 17 = 0, null, (id * 7919) % 1000) as int) as t",
        "cast(if(id % 11 = 0, null, id % 100) as decimal(10,2)) as v",
    ).cache()


@pytest.fixture(params=[100, 10**6])
def ranges_of(request, monkeypatch):
    """Rows per range: many ranges, or one for all rows."""
    monkeypatch.setattr("millrace.operators.windows.ROWS_PER_RANGE", request.param)
    return request.param


def test_running_total(skewed, ranges_of):
    plain = F.sum("v").over(W.partitionBy("k").orderBy("t", "id").rowsBetween(W.unboundedPreceding, 0))
    expected = skewed.withColumn("r", plain)
    found = running_total(skewed, "k", ["t", "id"], "v", "r")
    assert found.schema["r"].dataType == expected.schema["r"].dataType
    assert rows(found, "id") == rows(expected, "id")


def test_descending_text_order(skewed, ranges_of):
    order = W.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))
    expected = skewed.withColumns(
        {"r": F.sum("v").over(order.rowsBetween(W.unboundedPreceding, 0)), "p": F.lag("v").over(order)}
    )
    total = running_total(skewed, "k", "t desc, id desc", "v", "r")
    found = previous_value(total, "k", "t desc, id desc", "v", "p")
    assert found.dtypes == expected.dtypes
    assert rows(found, "id") == rows(expected, "id")


def test_reserved_names_are_refused(skewed):
    with pytest.raises(ValueError):
        running_total(skewed.withColumn("__key", F.lit(1)), "k", ["t", "id"], "v")


def test_previous_value(skewed, ranges_of):
    expected = skewed.withColumn("p", F.lag("v").over(W.partitionBy("k").orderBy("t", "id")))
    assert rows(previous_value(skewed, "k", ["t", "id"], "v", "p"), "id") == rows(expected, "id")


@pytest.mark.parametrize("order", [["t", "id"], ["same", "id"], ["name", "id"]])
def test_ranges_bound_the_largest_group(skewed, order, monkeypatch):
    """No task gets more than its share of the hot key, even if it has one time only."""
    from millrace.operators.windows import _KEY, _RANGE, _in_ranges

    df = skewed.withColumns({"same": F.lit(5), "name": F.lit("x")})
    monkeypatch.setattr("millrace.operators.windows.ROWS_PER_RANGE", df.count() // 40)
    ranges = _in_ranges(df, "k", order)
    assert ranges.groupBy(_KEY, _RANGE).count().agg(F.max("count")).first()[0] < 3000 / 40 * 2
    plain = F.sum("v").over(W.partitionBy("k").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    expected = df.withColumn("r", plain)
    assert rows(running_total(df, "k", order, "v", "r"), "id") == rows(expected, "id")


def test_running_total_of_times(spark):
    df = spark.range(200).selectExpr(
        "id", "id % 2 as k", "timestamp_ntz '2024-03-31 00:30:00' + make_dt_interval(0, 0, cast(id as int)) as t", "id as v"
    )
    expected = df.withColumn("r", F.sum("v").over(W.partitionBy("k").orderBy("t", "id")))
    assert rows(running_total(df, "k", ["t", "id"], "v", "r"), "id") == rows(expected, "id")


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, k int, t int, v int")
    assert running_total(df, "k", ["t", "id"], "v", "r").count() == 0
    assert previous_value(df, "k", ["t", "id"], "v", "p").count() == 0


def test_group_count(skewed):
    expected = skewed.withColumn("n", F.count("v").over(W.partitionBy("k")))
    assert rows(with_group_count(skewed, "k", "v", "n"), "id") == rows(expected, "id")
    two = skewed.withColumn("n", F.count("id").over(W.partitionBy("k", "t")))
    assert rows(with_group_count(skewed, "k,t", "id", "n"), "id") == rows(two, "id")


def test_top_per_group(skewed):
    top = top_per_group(skewed, "k", "t desc", 2)
    expected = skewed.withColumn("rank", F.rank().over(W.partitionBy("k").orderBy(F.desc("t")))).filter("rank <= 2")
    assert rows(top, "id") == rows(expected, "id")
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
