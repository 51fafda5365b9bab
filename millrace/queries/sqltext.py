"""Scripts over views of the tables: joins, aggregates, windows, sorting, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.windows import (
    previous_value,
    running_total,
    top_per_group,
    with_group_count,
)
from millrace.plans.script import run_script
from millrace.queries.base import query, table
from millrace.session import private_session


def script(spark: SparkSession, sf_dir: str, names: str, text: str) -> DataFrame:
    """Run SQL text over the named tables in a session of its own."""
    own = private_session(spark)
    return run_script(own, text, {name: table(own, sf_dir, name) for name in names.split()})


def sql_query(name: str, tables: str, text: str, oracle: str | None = None) -> None:
    """Register a script; both engines get the same text unless they spell it differently."""

    @query(name, oracle or text)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return script(spark, sf_dir, tables, text)


sql_query(
    "join_inner",
    "orders customer",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
sql_query(
    "join_left",
    "orders customer",
    """SELECT o_orderkey, coalesce(c_name, 'unknown') AS customer,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE 'other' END AS segment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""",
)
sql_query(
    "join_full",
    "orders customer",
    """SELECT coalesce(c_custkey, o_custkey) AS custkey, c_name, coalesce(order_count, 0) AS order_count
       FROM (SELECT * FROM customer WHERE c_acctbal > 0) c FULL JOIN
            (SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey) o
         ON c_custkey = o_custkey""",
)
sql_query(
    "join_right",
    "nation region",
    """SELECT r_name, n_name FROM nation
       RIGHT JOIN region ON n_regionkey = r_regionkey""",
)
sql_query(
    "join_semi",
    "customer orders",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
sql_query(
    "join_anti",
    "customer orders",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000)
                         WHERE o_custkey = c_custkey)""",
)
sql_query(
    "join_theta",
    "lineitem part",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_retailprice, l_extendedprice
       FROM lineitem JOIN part ON l_partkey = p_partkey
         AND l_extendedprice > p_retailprice * 40 AND l_quantity <> p_size""",
)
sql_query(
    "join_three_tables",
    "lineitem orders customer",
    # Lines are summed per order and orders per customer, so no join meets a hot key.
    """WITH per_order AS (
         SELECT l_orderkey, count(*) AS line_count, sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS price
         FROM lineitem GROUP BY l_orderkey),
       per_customer AS (
         SELECT o_custkey, sum(line_count) AS line_count, sum(price) AS price
         FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
       SELECT c_mktsegment, sum(line_count) AS line_count, CAST(sum(price) AS DOUBLE) AS price
       FROM per_customer JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    """SELECT c_mktsegment, count(*) AS line_count,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS price
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       GROUP BY c_mktsegment""",
)
sql_query(
    "agg_group_count",
    "events",
    "SELECT user_id, event_type, count(*) AS event_count FROM events GROUP BY user_id, event_type",
)
sql_query(
    "agg_conditional",
    "lineitem",
    """SELECT sum(if(l_quantity > 10, 0, 1)) AS small, sum(if(l_discount <= 0.05, 0, 1)) AS discounted,
              sum(if(l_returnflag = 'R', 0, 1)) AS kept FROM lineitem""",
    """SELECT CAST(sum(CASE WHEN l_quantity > 10 THEN 0 ELSE 1 END) AS BIGINT) AS small,
              CAST(sum(CASE WHEN l_discount <= 0.05 THEN 0 ELSE 1 END) AS BIGINT) AS discounted,
              CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS BIGINT) AS kept FROM lineitem""",
)
sql_query(
    "agg_count_if",
    "pages",
    """SELECT count(if(url rlike '/(en|fr)/', 1, null)) AS known, count_if(url like '%page=2%') AS second_page,
              count(*) AS pages FROM pages""",
    """SELECT count(CASE WHEN regexp_matches(url, '/(en|fr)/') THEN 1 END) AS known,
              count(*) FILTER (url LIKE '%page=2%') AS second_page, count(*) AS pages FROM pages""",
)
sql_query("agg_row_count", "lineitem", "SELECT count(*) AS row_count FROM lineitem")
sql_query(
    "agg_distinct",
    "lineitem",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts
       FROM lineitem GROUP BY l_returnflag""",
)
sql_query(
    "select_distinct",
    "orders",
    "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
)
sql_query(
    "agg_rollup",
    "lineitem",
    """SELECT l_returnflag, l_linestatus, count(*) AS line_count,
              CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
       FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
sql_query(
    "agg_cube",
    "orders",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS order_count
       FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
sql_query(
    "agg_grouping_sets",
    "orders",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS order_count, CAST(max(o_totalprice) AS DOUBLE) AS top
       FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""",
)
sql_query(
    "first_row",
    "orders",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
)
sql_query(
    "sort_limit",
    "lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100""",
)
sql_query(
    "set_union_all",
    "customer supplier",
    """SELECT c_nationkey AS nationkey, c_name AS name FROM customer
       UNION ALL SELECT s_nationkey, s_name FROM supplier""",
)
sql_query(
    "set_union",
    "customer supplier",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
sql_query(
    "set_intersect",
    "lineitem part",
    """SELECT l_partkey AS partkey FROM (SELECT DISTINCT l_partkey FROM lineitem)
       INTERSECT SELECT p_partkey FROM part""",
)
sql_query(
    "set_except",
    "customer orders",
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'",
)
sql_query(
    "set_except_all",
    "orders",
    """SELECT o_orderkey, o_custkey FROM orders
       EXCEPT ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'""",
)


@query(
    "window_count",
    "SELECT o_orderkey, o_custkey, count(o_orderkey) OVER (PARTITION BY o_custkey) AS group_count FROM orders",
)
def window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return with_group_count(orders, "o_custkey", "o_orderkey")


@query(
    "window_topk",
    """
    SELECT event_id, event_type, user_id, value, rank FROM (
      SELECT *, rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS rank FROM events) WHERE rank <= 10
    """,
)
def window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    top = top_per_group(events, "event_type", "value desc", 10)
    return top.withColumn("rank", top["rank"].cast("bigint"))


@query(
    "window_topk_after_group",
    """
    SELECT user_id, event_type, event_count, place FROM (
      SELECT *, rank() OVER (PARTITION BY event_type ORDER BY event_count DESC, user_id) AS place
      FROM (SELECT user_id, event_type, count(*) AS event_count FROM events GROUP BY ALL)) WHERE place <= 3
    """,
)
def window_topk_after_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """SELECT user_id, event_type, event_count, cast(place as bigint) as place FROM (
                SELECT *, rank() OVER (PARTITION BY event_type ORDER BY event_count DESC, user_id) AS place
                FROM (SELECT user_id, event_type, count(*) AS event_count FROM events
                      GROUP BY user_id, event_type)) WHERE place <= 3"""
    return script(spark, sf_dir, "events", text)


@query(
    "window_running",
    """
    SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER
             (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total
    FROM events
    """,
)
def window_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts", "cast(value as decimal(12,2)) as value"
    )
    totals = running_total(events, "user_id", ["ts", "event_id"], "value")
    return totals.selectExpr("event_id", "user_id", "cast(running_total as double) as running_total")


@query(
    "window_lag",
    """
    SELECT event_id, event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_value
    FROM events
    """,
)
def window_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return previous_value(events, "event_type", ["ts", "event_id"], "value").drop("ts")
