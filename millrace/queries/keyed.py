"""Upsert, delete-before-load, cells, ranges, surrogate keys and key/value shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cells import range_sorted, scan_cells, to_cells
from millrace.operators.keyed import delete_then_append, upsert_by_key, with_surrogate_key
from millrace.queries.base import query, table
from millrace.session import scratch_dir
from millrace.sinks import write_sink
from millrace.sinks.registry import key_value
from millrace.sources import read_source


@query(
    "upsert_latest",
    """
    SELECT event_id, ts, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    current = events.filter("event_type <> 'purchase'")
    incoming = events.filter("event_type = 'purchase'")
    return upsert_by_key(current, incoming, "user_id", "ts,event_id")


@query(
    "upsert_into_keyed",
    """
    SELECT o_orderkey AS uuid, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS ts FROM orders
    UNION ALL
    SELECT -1 - c_custkey, 'new', TIMESTAMP '2000-01-01 00:00:00' FROM customer
    """,
)
def upsert_into_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with one row per key: changes, stale repeats and new keys come in."""
    current = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as uuid", "o_orderstatus as status", "o_orderdate as ts"
    )
    closed = current.filter("status = 'F'").selectExpr(
        "uuid", "'closed' as status", "ts + interval 1 day as ts"
    )
    stale = current.filter("status = 'O'").selectExpr(
        "uuid", "'stale' as status", "ts - interval 1 day as ts"
    )
    new = table(spark, sf_dir, "customer").selectExpr(
        "-1 - c_custkey as uuid", "'new' as status", "timestamp_ntz '2000-01-01 00:00:00' as ts"
    )
    incoming = closed.unionByName(stale).unionByName(new)
    return upsert_by_key(current, incoming, current_is_keyed=True)


@query(
    "delete_then_append",
    """
    SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status, o_totalprice FROM orders
    WHERE NOT coalesce(nullif(o_orderstatus, 'O') = 'P' OR o_totalprice > 400000, false)
    UNION ALL SELECT o_orderkey, 'again', o_totalprice FROM orders WHERE o_orderstatus = 'P'
    """,
)
def delete_then_append_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    current = orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'O') as status", "o_totalprice")
    again = orders.filter("o_orderstatus = 'P'").selectExpr(
        "o_orderkey", "'again' as status", "o_totalprice"
    )
    return delete_then_append(current, "status = 'P' or o_totalprice > 400000", again)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "lpad(c_custkey, 9, '0') as row_key",
        "c_name as `cf1:Name`",
        "nullif(c_mktsegment, 'BUILDING') as `cf2:segment`",
        "c_nationkey as nation",
        "if(c_nationkey = 3, '', 'x') as `cf2:mark`",
    )


@query(
    "to_cells",
    """
    WITH w AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key, * FROM customer)
    SELECT row_key, 'cf1' AS family, 'Name' AS qualifier, c_name AS value FROM w
    UNION ALL SELECT row_key, 'cf2', 'segment', c_mktsegment FROM w WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT row_key, 'cf1', 'nation', CAST(c_nationkey AS VARCHAR) FROM w
    UNION ALL SELECT row_key, 'cf2', 'mark', 'x' FROM w WHERE c_nationkey <> 3
    """,
)
def to_cells_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(_wide(spark, sf_dir))


@query(
    "row_range_scan",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key, c_name AS name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment
    FROM customer
    WHERE lpad(CAST(c_custkey AS VARCHAR), 9, '0') >= '000000010' AND lpad(CAST(c_custkey AS VARCHAR), 9, '0') < '9'
    """,
)
def row_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells written as files by the sink and scanned by the source."""
    out = scratch_dir(spark, "cells") + "/customer"
    write_sink(_wide(spark, sf_dir), {"type": "hbase", "options": {"paths": out, "fileType": "parquet"}})
    return read_source(
        spark,
        {
            "type": "hbase",
            "options": {"paths": out, "fileType": "parquet"},
            "fields": "cf1:name,cf2:SEGMENT",
            "where": "000000010,9",
        },
    ).withColumnRenamed("SEGMENT", "segment")


@query(
    "scan_open_range",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key, 'x' AS mark FROM customer
    WHERE c_nationkey <> 3 AND lpad(CAST(c_custkey AS VARCHAR), 9, '0') >= '00000005'
    """,
)
def scan_open_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without any of the chosen cells are absent."""
    return scan_cells(to_cells(_wide(spark, sf_dir)), "cf2:mark", "00000005")


SPLITS = ("000000200", "000000500", "000001000")


@query(
    "range_buckets",
    """
    WITH w AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key, c_name FROM customer)
    SELECT row_key, c_name, CASE WHEN row_key < '000000200' THEN 0 WHEN row_key < '000000500' THEN 1
           WHEN row_key < '000001000' THEN 2 ELSE 3 END AS range_bucket FROM w
    """,
)
def range_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("lpad(c_custkey, 9, '0') as row_key", "c_name")
    return range_sorted(rows, SPLITS)


@query(
    "bulk_load_files",
    """
    SELECT CASE WHEN row_key < '000000200' THEN 0 WHEN row_key < '000000500' THEN 1
           WHEN row_key < '000001000' THEN 2 ELSE 3 END AS range_bucket, count(*) AS cells,
           min(row_key) AS first_key, max(row_key) AS last_key
    FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key FROM customer
          UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') FROM customer WHERE c_mktsegment <> 'BUILDING'
          UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') FROM customer
          UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') FROM customer WHERE c_nationkey <> 3)
    GROUP BY 1
    """,
)
def bulk_load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "bulk") + "/customer"
    options = {
        "paths": out,
        "fileType": "parquet",
        "write_mode": "hfile",
        "splits": ",".join(SPLITS),
    }
    write_sink(_wide(spark, sf_dir), {"type": "hbase", "options": options})
    return (
        spark.read.parquet(out)
        .groupBy("range_bucket")
        .agg(
            F.count(F.lit(1)).alias("cells"),
            F.min("row_key").alias("first_key"),
            F.max("row_key").alias("last_key"),
        )
    )


@query(
    "bulk_load_balanced",
    """
    WITH w AS (SELECT 'k/' || CASE WHEN o_custkey % 3 = 0 THEN '0/' ELSE '9/' END || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS row_key,
                      o_orderstatus AS value FROM orders)
    SELECT row_key, 'cf1' AS family, 'status' AS qualifier, value, true AS balanced FROM w
    """,
)
def bulk_load_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges cut from the data: sixteen, none with twice its share, though the keys are dense in two places."""
    out = scratch_dir(spark, "bulk") + "/orders"
    rows = table(spark, sf_dir, "orders").selectExpr(
        "concat('k/', if(o_custkey % 3 = 0, '0/', '9/'), lpad(o_orderkey, 9, '0')) as row_key", "o_orderstatus as `cf1:status`"
    )
    options = {"paths": out, "fileType": "parquet", "write_mode": "hfile", "splits": "auto:16"}
    write_sink(rows, {"type": "hbase", "options": options})
    cells = spark.read.parquet(out)
    ranges = cells.groupBy("range_bucket").agg(F.count(F.lit(1)).alias("n"))
    even = ranges.agg(((F.max("n") < 2 * F.sum("n") / 16) & (F.count(F.lit(1)) == 16)).alias("even")).first().even
    return cells.select("row_key", "family", "qualifier", "value", F.lit(even).alias("balanced"))


@query(
    "surrogate_key",
    "SELECT count(*) AS rows_written, count(*) AS distinct_keys, 32 AS key_length FROM lineitem",
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys are random; what holds is that no two are the same."""
    keyed = with_surrogate_key(table(spark, sf_dir, "lineitem"), "auto_md5")
    per_key = keyed.groupBy("auto_md5").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("rows_written"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.max(F.length("auto_md5")).alias("key_length"),
    )


@query(
    "key_value_messages",
    """
    SELECT CAST(event_id AS VARCHAR) AS key, '{"key":' || event_id || ',"kind":"' || event_type || '"}' AS value
    FROM events
    """,
)
def key_value_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr("event_id as key", "event_type as kind")
    return key_value(events)
