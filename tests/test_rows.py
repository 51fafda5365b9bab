import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.keyed import (
    delete_then_append,
    require_key,
    upsert_by_key,
    upsert_fields,
    with_surrogate_key,
)
from millrace.operators.rows import compact, redistribute, select_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_then_dedup(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "e", 0)], "k int, v string, o int")
    assert select_rows(df, " ").count() == 5
    assert rows(select_rows(df, "o > 1", "k", "o")) == [(1, "b", 2)]
    assert rows(select_rows(df, None, "k", "o desc, v"), "v") == [(1, "a", 3), (2, "c", 1), (None, "d", 1)]
    assert select_rows(df, None, "k").count() == 3


def test_ordered_dedup_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    first = select_rows(df, None, "k", "v desc")
    assert first.count() == 667
    assert first.filter("k = 0").first()["v"] == 999
    plan = plan_of(first)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize(
    ("count", "columns", "partitions"), [("3", "", 3), (5, "id", None), ("", "id", None), (None, None, 2)]
)
def test_redistribute(spark, count, columns, partitions):
    df = redistribute(spark.range(0, 100, 1, 2), count, columns)
    assert df.count() == 100
    if partitions:
        assert df.rdd.getNumPartitions() == partitions


def test_compact(spark, folder):
    df = spark.range(0, 1000, 1, 8)
    assert compact(df, "-1") is df and compact(df, "") is df
    for merge, most in (("3", 3), ("auto", 4)):
        compact(df, merge).write.parquet(f"{folder}/{merge}")
        back = spark.read.parquet(f"{folder}/{merge}")
        assert back.count() == 1000
        assert len(back.inputFiles()) <= most


CURRENT = [(1, "a", 10), (2, "b", 20), (3, "c", None), (4, "d", 5)]
INCOMING = [(1, "a2", 11), (1, "a3", 9), (2, "b2", 20), (3, "c2", 1), (4, "stale", 4), (5, "new", 1), (None, "nk", 1)]
MERGED = [(None, "nk", 1), (1, "a2", 11), (2, "b2", 20), (3, "c2", 1), (4, "d", 5), (5, "new", 1)]


@pytest.mark.parametrize("keyed", [False, True])
def test_upsert(spark, keyed):
    schema = "uuid int, v string, ts int"
    current = spark.createDataFrame(CURRENT, schema)
    incoming = spark.createDataFrame(INCOMING, schema)
    merged = upsert_by_key(current, incoming, current_is_keyed=keyed)
    assert rows(merged) == MERGED
    assert rows(upsert_by_key(merged, incoming, current_is_keyed=keyed)) == MERGED


def test_upsert_with_a_hot_key(spark):
    current = spark.range(300).selectExpr("id as uuid", "'old' as v", "0 as ts")
    incoming = spark.range(900).selectExpr("if(id % 3 = 0, 7, id) as uuid", "concat('n', id) as v", "cast(id as int) as ts")
    for keyed in (False, True):
        merged = upsert_by_key(current, incoming, current_is_keyed=keyed)
        assert merged.count() == merged.select("uuid").distinct().count() == 700
        assert merged.filter("uuid = 7").first()["v"] == "n897"
        assert merged.filter("v = 'old'").count() == 100  # ids 0, 3, ... 297


def test_upsert_fields():
    assert upsert_fields(["uuid", "ts"], "", None) == ("uuid", "ts")
    assert upsert_fields(["id", "t"], "id", "t") == ("id", "t")
    with pytest.raises(ValueError, match="record key"):
        upsert_fields(["ts"], "", "")
    with pytest.raises(ValueError, match="precombine"):
        upsert_fields(["uuid"], "", "")


def test_delete_then_append_keeps_unknown(spark):
    current = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, v string")
    new = spark.createDataFrame([("z", 9)], "v string, id int")
    assert rows(delete_then_append(current, "v = 'x'", new)) == [(2, None), (3, "y"), (9, "z")]
    assert delete_then_append(current, " ", new).count() == 4
    assert delete_then_append(current, F.col("id") >= 2, new).count() == 2


def test_surrogate_key(spark):
    keyed = with_surrogate_key(spark.range(0, 5000, 1, 8), "k")
    seen = keyed.select("k").distinct()
    assert seen.count() == 5000
    assert {len(r["k"]) for r in seen.limit(10).collect()} == {32}


def test_required_key(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert rows(require_key(df, "a")) == [(1, None)]
    with pytest.raises(Exception, match="key column b"):
        require_key(df, "b").collect()
