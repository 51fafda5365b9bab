"""Plans the queries must have to hold at scale."""

import pytest

from millrace.queries import REGISTRY
from millrace.queries.base import table
from millrace.session import session_conf
from millrace.sources.registry import read_source

SF_DIR = "/root/testdata/sf0.001"
QUERIES = dict(REGISTRY)
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def plan(spark, name):
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "10000"}):
        return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_forced_broadcast_no_row_python(spark, name):
    with session_conf(spark, NO_BROADCAST):
        text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "BatchEvalPython"):
        assert node not in text


@pytest.mark.parametrize("name", ["dedup_first", "upsert_latest", "window_topk", "window_topk_after_group"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


@pytest.mark.parametrize(
    ("name", "pushed", "columns"),
    [
        ("filter_predicates", "GreaterThanOrEqual(l_shipdate", 8),
        ("parquet_source", "GreaterThanOrEqual(o_orderdate", 3),
        ("etl_apply", "GreaterThan(s_acctbal", 3),
        ("dedup_keys", "PushedFilters", 2),
        ("join_inner", "IsNotNull(o_custkey)", 3),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    text = plan(spark, name)
    if name != "etl_apply":  # its result is read from what the task wrote
        assert pushed in text
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert len(schema.split(",")) <= columns


def test_quality_reads_once(spark):
    assert plan(spark, "quality_inline_keys").count("FileScan") == 1
    assert plan(spark, "quality_rules_sql").count("FileScan") == 1
    assert plan(spark, "quality_rules_regex").count("FileScan") == 1
    assert plan(spark, "quality_rules_key").count("FileScan") == 1
    assert plan(spark, "quality_rules_many").count("FileScan") == 1


def test_sort_limit_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "sort_limit")


def test_partition_filter(spark, folder):
    table(spark, SF_DIR, "orders").write.partitionBy("o_orderstatus").parquet(f"{folder}/orders")
    read = read_source(
        spark,
        {"type": "hdfs", "options": {"fileType": "parquet", "paths": f"{folder}/orders"}, "where": "o_orderstatus = 'O'"},
    )
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_a_report_is_computed_once(spark):
    text = plan(spark, "quality_task")
    assert "FileScan" not in text
