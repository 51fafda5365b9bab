"""Whole tasks, and the mapping, filter and partitioning steps they are made of."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.rows import compact, redistribute, select_rows
from millrace.operators.transform import (
    identity_mapping,
    map_columns,
    rename_all,
    select_fields,
    split_fields,
    strip_family,
)
from millrace.plans.jobs import (
    APPLY_BLOCK,
    ETL_BLOCK,
    MULTI_BLOCK,
    QUALITY_BLOCK,
    RULES_BLOCK,
    SQL_BLOCK,
    run_apply,
    run_etl,
    run_multi,
    run_quality,
    run_rules,
    run_sql,
)
from millrace.queries.base import query, table, table_path
from millrace.schema import fields_to_schema
from millrace.session import scratch_dir
from millrace.sinks import write_sink

RUN_DATE = "2024-01-31"


def column(expr: str, alias: str, kind: str = "", **checks: str) -> dict[str, str]:
    return {"column_expr": expr, "column_alias": alias, "column_type": kind, **checks}


def run_block() -> dict:
    return {"job_id": "1", "params": json.dumps({"ETL_DATE": RUN_DATE}), "job_context": "load"}


def parquet_input(sf_dir: str, name: str, **info) -> dict:
    return {
        "file_type_input": "parquet",
        "data_sources_params_input": json.dumps({"paths": table_path(sf_dir, name)}),
        **info,
    }


def file_output(path: str, kind: str = "parquet", **info) -> dict:
    return {
        "file_type_output": kind,
        "model_output": "overwrite",
        "data_sources_params_output": json.dumps({"paths": path}),
        **info,
    }


HDFS = {"data_source_type": "hdfs"}


@query(
    "etl_single_source",
    """
    SELECT CAST(o_orderkey + 1 AS BIGINT) AS id, upper(o_orderpriority) AS priority,
           CAST(CAST(o_totalprice AS DECIMAL(12,1)) AS DOUBLE) AS price, DATE '2024-01-31' AS etl_date,
           CAST(o_custkey AS VARCHAR) AS row_key
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
          FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1
    """,
)
def etl_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "etl") + "/orders"
    info = {
        **parquet_input(sf_dir, "orders"),
        **file_output(out),
        "data_sources_filter_input": "o_orderstatus = 'F'",
        "duplicate_columns": "o_custkey",
        "duplicate_order_by": "o_orderdate desc, o_orderkey",
        "column_data_list": [
            column("o_orderkey + 1", "id", "bigint"),
            column("upper(o_orderpriority)", "priority"),
            column("o_totalprice", "price", "decimal(12,1)"),
            column("$etl_date", "etl_date", "date"),
            column("o_custkey", "row_key"),
        ],
        "repartition_cols_input": "id",
    }
    task = {"tli": run_block(), "dsi_Input": HDFS, "dsi_Output": HDFS, ETL_BLOCK: info}
    run_etl(spark, task)
    written = spark.read.parquet(out)
    return written.withColumn("price", F.col("price").cast("double"))


@query(
    "etl_quality_gate",
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer",
)
def etl_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "gate") + "/customer"
    info = {
        **parquet_input(sf_dir, "customer"),
        **file_output(out, "csv", header_output="true"),
        "enable_quality": "on",
        "primary_columns": "c_custkey",
        "column_size": "5",
        "column_data_list": [
            column("c_custkey", "id", column_name="c_custkey", column_is_null="false"),
            column(
                "c_name",
                "name",
                column_name="c_name",
                column_regex=r"Customer#\d{9}",
                column_length="18",
            ),
            column("c_acctbal", "balance"),
        ],
    }
    task = {"tli": run_block(), "dsi_Input": HDFS, "dsi_Output": HDFS, ETL_BLOCK: info}
    run_etl(spark, task)
    return spark.read.csv(out, header=True, schema="id bigint, name string, balance double")


@query(
    "etl_apply",
    "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier WHERE s_acctbal > 0",
)
def etl_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "apply") + "/supplier"
    info = {
        **parquet_input(sf_dir, "supplier"),
        **file_output(out, "orc"),
        "data_sources_filter_input": "s_acctbal > 0",
        "column_data_list": [
            column("s_suppkey", "id"),
            column("s_name", "name"),
            column("s_nationkey", "nation"),
        ],
    }
    task = {"tli": run_block(), "dsi_Input": HDFS, "dsi_Output": HDFS, APPLY_BLOCK: info}
    run_apply(spark, task)
    return spark.read.orc(out)


MULTI_SCRIPT = """--table open orders=o;
--table all customers=c;
--table nations=n;
create or replace temporary view per_customer as
select custkey, sum(cast(price as decimal(14,2))) as revenue, count(*) as order_count
from o group by custkey;

select n.name as nation, cast(sum(p.revenue) as double) as revenue,
       sum(p.order_count) as order_count, count(*) as customers, cast($etl_date as date) as etl_date
from per_customer p join c on p.custkey = c.custkey join n on c.nationkey = n.nationkey
group by n.name
"""


def multi_task(sf_dir: str, out: str | None) -> dict:
    sources = [
        (
            "orders",
            "open orders",
            "o_orderstatus <> 'P'",
            [column("o_custkey", "custkey"), column("o_totalprice", "price")],
        ),
        (
            "customer",
            "all customers",
            "",
            [column("c_custkey", "custkey"), column("c_nationkey", "nationkey")],
        ),
        (
            "nation",
            "nations",
            "",
            [column("n_nationkey", "nationkey"), column("n_name", "name")],
        ),
    ]
    task = {
        "tli": run_block(),
        "dsi_EtlInfo": [
            {
                "dsi_Input": HDFS,
                ETL_BLOCK: parquet_input(
                    sf_dir,
                    name,
                    etl_context=context,
                    data_sources_filter_input=where,
                    column_data_list=mapping,
                ),
            }
            for name, context, where, mapping in sources
        ],
        MULTI_BLOCK: {"etl_sql": MULTI_SCRIPT},
    }
    if out:
        task["dsi_Output"] = HDFS
        task[MULTI_BLOCK].update(file_output(out))
    return task


MULTI_SQL = """
    SELECT n_name AS nation, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue,
           count(*) AS order_count, count(DISTINCT o_custkey) AS customers, DATE '2024-01-31' AS etl_date
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus <> 'P' GROUP BY n_name
"""


@query("etl_multi_source", MULTI_SQL)
def etl_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "multi") + "/revenue"
    run_multi(spark, multi_task(sf_dir, out))
    return spark.read.parquet(out)


@query(
    "sql_script",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS line_count,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)
             AS sum_disc_price
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-12-31 00:00:00' GROUP BY l_returnflag, l_linestatus
    """,
)
def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL task: the statements run in order, the last one goes to the sink."""
    out = scratch_dir(spark, "sql") + "/summary"
    script = (
        "create temporary view lines using parquet options (path "
        f"'{table_path(sf_dir, 'lineitem')}');\n"
        "select count(*) from lines where l_tax < 0;\n\n;\n"
        """select l_returnflag, l_linestatus, count(*) as line_count,
                  cast(sum(cast(l_quantity as decimal(12,2))) as double) as sum_qty,
                  cast(sum(cast(l_extendedprice as decimal(14,2)) * (1 - cast(l_discount as decimal(4,2)))) as double)
                    as sum_disc_price
           from lines where l_shipdate <= timestamp_ntz '2000-12-31 00:00:00'
           group by l_returnflag, l_linestatus;"""
    )
    task = {"tli": run_block(), "dsi_Output": HDFS, SQL_BLOCK: {"etl_sql": script, **file_output(out)}}
    run_sql(spark, task)
    return spark.read.parquet(out)


@query(
    "sql_script_without_sink",
    """
    SELECT event_type, CAST('2024-01-31' AS DATE) AS etl_date, count(*) AS event_count
    FROM events GROUP BY event_type
    """,
)
def sql_script_without_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    script = (
        f"create temporary view e using parquet options (path '{table_path(sf_dir, 'events')}');\n"
        "select event_type, cast($site_etl_date as date) as etl_date, count(*) as event_count "
        "from e group by event_type"
    )
    return run_sql(spark, {"tli": run_block(), SQL_BLOCK: {"etl_sql": script}}).frame


RULES = [
    {"when": "price >= 250000", "set": {"band": "'high'", "flag": "'true'"}},
    {"when": "price < 250000", "set": {"band": "'low'"}},
    {"when": "band = 'low' and status = 'F'", "set": {"status": "'CLOSED'"}},
]


@query(
    "rules_rewrite",
    """
    SELECT CASE WHEN o_totalprice >= 250000 THEN 'high' ELSE 'low' END AS band,
           CASE WHEN o_totalprice >= 250000 THEN 'true' END AS flag,
           CAST(o_orderkey AS VARCHAR) AS id,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
           CASE WHEN o_totalprice < 250000 AND o_orderstatus = 'F' THEN 'CLOSED' ELSE o_orderstatus END AS status
    FROM orders WHERE CASE WHEN o_totalprice < 250000 AND o_orderstatus = 'F' THEN 'CLOSED' ELSE o_orderstatus END <> 'P'
    """,
)
def rules_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule task over one source: rules, a filter on their result, a sink."""
    out = scratch_dir(spark, "rules") + "/orders"
    source = parquet_input(
        sf_dir,
        "orders",
        column_data_list=[
            column("o_orderkey", "id"),
            column("o_totalprice", "price", "decimal(12,2)"),
            column("o_orderstatus", "status"),
        ],
    )
    task = {
        "tli": run_block(),
        "dsi_EtlInfo": [{"dsi_Input": HDFS, ETL_BLOCK: source}],
        "dsi_Output": HDFS,
        RULES_BLOCK: {
            "more_task": "ETL",
            "etl_drools": json.dumps(RULES),
            "data_sources_filter_input": "status <> 'P'",
            **file_output(out),
        },
    }
    run_rules(spark, task)
    return spark.read.parquet(out)


@query(
    "rules_on_multi",
    """
    SELECT CAST(count(*) AS VARCHAR) AS customers, CASE WHEN count(*) >= 60 THEN 'big' ELSE 'small' END AS size,
           n_name AS nation, CASE WHEN count(*) >= 60 THEN '2024-01-31' END AS reviewed
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
    """,
)
def rules_on_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over a multi-source script whose views are named ``source#view``."""
    sources = [
        ("customer", "clients#c", [column("c_nationkey", "nk")]),
        ("nation", "countries#n", [column("n_nationkey", "nk"), column("n_name", "nation")]),
    ]
    task = {
        "tli": run_block(),
        "dsi_EtlInfo": [
            {
                "dsi_Input": HDFS,
                ETL_BLOCK: parquet_input(
                    sf_dir, name, etl_context=context, column_data_list=mapping
                ),
            }
            for name, context, mapping in sources
        ],
        MULTI_BLOCK: {
            "etl_sql": "select n.nation, count(*) as customers from c join n on c.nk = n.nk group by n.nation"
        },
        RULES_BLOCK: {
            "more_task": "MORE_ETL",
            "etl_drools": json.dumps(
                [
                    {"set": {"size": "'small'"}},
                    {"when": "customers >= 60", "set": {"size": "'big'", "reviewed": "$etl_date"}},
                ]
            ),
        },
    }
    return run_rules(spark, task).frame


@query(
    "rules_on_sql",
    """
    SELECT CAST(event_count AS VARCHAR) AS event_count, event_type AS kind,
           CASE WHEN event_type IN ('error') THEN 'alert' END AS level
    FROM (SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type)
    """,
)
def rules_on_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    script = (
        f"create temporary view e using parquet options (path '{table_path(sf_dir, 'events')}');\n"
        "select event_type as kind, count(*) as event_count from e group by event_type;\n"
    )
    task = {
        "tli": run_block(),
        SQL_BLOCK: {"etl_sql": script},
        RULES_BLOCK: {
            "more_task": "SQL",
            "etl_drools": [{"when": "kind in ('error')", "set": {"level": "'alert'"}}],
        },
    }
    return run_rules(spark, task).frame


@query(
    "quality_task",
    """
    WITH v AS (
      SELECT 0 AS seq, 'K1' AS rule_code, 'unique line' AS rule_name, 'l_orderkey,l_linenumber' AS column_name,
             (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM
               (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1) AS violations
      UNION ALL SELECT 1, 'S1', 'small discount', 'l_discount',
             (SELECT count(*) FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, false))
      UNION ALL SELECT 2, 'R1', 'flag letter', 'l_returnflag',
             (SELECT count(*) FROM lineitem WHERE NOT regexp_matches(l_returnflag, '^[AN]'))
      UNION ALL SELECT 3, 'R1', 'flag letter', 'l_linestatus',
             (SELECT count(*) FROM lineitem WHERE NOT regexp_matches(l_linestatus, '^[AN]')))
    SELECT seq, rule_code, rule_name, column_name, violations,
           'column ' || column_name || ': rule ' || rule_name || ': ' || violations || ' rows do not conform' AS message
    FROM v WHERE violations > 0
    UNION ALL
    SELECT 4, 'result', NULL, NULL, (SELECT count(*) FROM v WHERE violations > 0),
           CASE WHEN (SELECT count(*) FROM v WHERE violations > 0) > 0 THEN 'fail' ELSE 'pass' END
    """,
)
def quality_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {
            "rule_type": "2",
            "rule_code": "R1",
            "rule_name": "flag letter",
            "rule_expr": "^[AN]",
            "quality_columns": "l_returnflag,l_linestatus",
        },
        {
            "rule_type": "1",
            "rule_code": "S1",
            "rule_name": "small discount",
            "rule_expr": "$column <= 0.05",
            "quality_columns": "l_discount",
        },
        {
            "rule_type": "3",
            "rule_code": "K1",
            "rule_name": "unique line",
            "rule_expr": "primary_key_check",
            "quality_columns": "l_orderkey,l_linenumber",
        },
    ]
    info = parquet_input(sf_dir, "lineitem", quality_rule_config=json.dumps(rules))
    return run_quality(spark, {"tli": run_block(), "dsi_Input": HDFS, QUALITY_BLOCK: info}).frame


@query(
    "map_cast_types",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS row_key, TRY_CAST(p_name AS INTEGER) IS NULL AS cast_failed,
           CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no,
           CAST(p_size AS DOUBLE) AS size, CAST(CAST(p_retailprice AS DECIMAL(12,1)) AS DOUBLE) AS price,
           p_size * 2 + 1 AS size_plus, p_size > 10 AS is_large, CAST(p_size AS SMALLINT) AS size_short
    FROM part
    """,
)
def map_cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = map_columns(
        table(spark, sf_dir, "part"),
        [
            column("p_partkey", "row_key", "bigint"),
            column("p_name", "not_a_number", "int"),
            column("replace(p_brand, 'Brand#', '')", "brand_no", "int"),
            column("p_size", "size", "double"),
            column("p_retailprice", "price", "decimal(12,1)"),
            column("p_size * 2 + 1", "size_plus"),
            column("p_size > 10", "is_large"),
            column("p_size", "size_short", "smallint"),
        ],
    )
    return mapped.select(
        "row_key",
        F.isnull("not_a_number").alias("cast_failed"),
        "brand_no",
        "size",
        F.col("price").cast("double").alias("price"),
        "size_plus",
        "is_large",
        "size_short",
    )


@query(
    "map_run_date",
    """
    SELECT o_orderkey AS id, '2024-01-31' AS etl_text, DATE '2024-01-31' AS etl_date,
           date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-01-31') AS age_days
    FROM orders
    """,
)
def map_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(
        table(spark, sf_dir, "orders"),
        [
            column("o_orderkey", "id"),
            column("$etl_date", "etl_text"),
            column("$etl_date", "etl_date", "date"),
            column("datediff($etl_date, o_orderdate)", "age_days", "bigint"),
        ],
        RUN_DATE,
    )


@query("map_identity", "SELECT r_regionkey, r_name FROM region")
def map_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return map_columns(map_columns(region, None), identity_mapping(region.columns))


@query("select_field_list", "SELECT o_orderdate, o_orderkey FROM orders")
def select_field_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_fields(table(spark, sf_dir, "orders"), "o_orderdate, o_orderkey")


@query("rename_by_position", "SELECT n_nationkey AS id, n_name AS label, n_regionkey AS region FROM nation")
def rename_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a spreadsheet source does with its columns."""
    return rename_all(table(spark, sf_dir, "nation"), "id,label,region")


@query(
    "split_positional",
    """
    SELECT nullif(split_part(line, '|', 1), '') AS id, nullif(split_part(line, '|', 2), '') AS name,
           nullif(split_part(line, '|', 3), '') AS segment, CAST(NULL AS VARCHAR) AS missing
    FROM (SELECT c_custkey || '|' || c_name || '|' || CASE WHEN c_mktsegment = 'BUILDING' THEN ''
                 ELSE c_mktsegment END AS line FROM customer)
    """,
)
def split_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    lines = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey"), F.lit("|"), F.col("c_name"), F.lit("| "), segment).alias("line")
    )
    return split_fields(lines, "line", "|", "id,name,segment,missing", trim=True).withColumn(
        "segment", F.nullif("segment", F.lit(""))
    )


@query("family_prefix_mapping", "SELECT c_custkey AS id, upper(c_name) AS name FROM customer")
def family_prefix_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = [column("cf1:c_custkey", "id"), column("cf2:upper(c_name)", "name")]
    return map_columns(table(spark, sf_dir, "customer"), strip_family(mapping))


@query(
    "nested_schema_json",
    """
    SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment,
           CAST(NULL AS VARCHAR) AS absent FROM customer
    """,
)
def nested_schema_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fields_to_schema("name,job.nation,job.market.segment,job.absent as ignored")
    documents = table(spark, sf_dir, "customer").select(
        F.to_json(
            F.struct(
                F.col("c_name").alias("name"),
                F.struct(
                    F.col("c_nationkey").alias("nation"),
                    F.struct(F.col("c_mktsegment").alias("segment")).alias("market"),
                ).alias("job"),
            )
        ).alias("value")
    )
    return (
        documents.select(F.from_json("value", schema).alias("data"))
        .select("data.*")
        .select("name", "job.nation", "job.market.segment", "job.absent")
    )


@query(
    "filter_predicates",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' AND l_discount BETWEEN 0.02 AND 0.07
      AND (l_returnflag IN ('A', 'R') OR l_linestatus LIKE 'O%')
      AND NOT (l_quantity < 10) AND l_tax IS NOT NULL
    """,
)
def filter_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select_rows(
        table(spark, sf_dir, "lineitem"),
        """l_shipdate >= timestamp_ntz '1996-01-01 00:00:00' and l_discount between 0.02D and 0.07D
           and (l_returnflag in ('A', 'R') or l_linestatus like 'O%')
           and not (l_quantity < 10) and l_tax is not null""",
    )
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


_LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


@query(
    "dedup_first",
    f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) AS rn
      FROM lineitem) WHERE rn = 1
    """,
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_rows(
        table(spark, sf_dir, "lineitem"), None, "l_orderkey,l_linenumber", _LINE_ORDER
    )


@query(
    "dedup_keys",
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
)
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row stays is open, so only the key columns are shown."""
    rows = select_rows(table(spark, sf_dir, "lineitem"), None, "l_orderkey,l_linenumber")
    return rows.select("l_orderkey", "l_linenumber")


@query("repartition_rows", "SELECT o_orderkey, o_custkey FROM orders")
def repartition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return redistribute(orders, None, "o_custkey,o_orderkey")


@query("compact_files", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A write whose files Spark sizes."""
    out = scratch_dir(spark, "compact") + "/events"
    compact(table(spark, sf_dir, "events"), "auto").write.parquet(out)
    return spark.read.parquet(out)


@query(
    "etl_wide_row_source",
    """
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS row_key, upper(s_name) AS name, s_acctbal AS balance
    FROM supplier WHERE lpad(CAST(s_suppkey AS VARCHAR), 6, '0') >= '000007'
    """,
)
def etl_wide_row_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task over cells: the filter is a key range and expressions name family and cell."""
    folder = scratch_dir(spark, "wide")
    cells = {"paths": folder + "/cells", "fileType": "parquet"}
    wide = table(spark, sf_dir, "supplier").selectExpr(
        "lpad(s_suppkey, 6, '0') as row_key", "s_name as `cf1:name`", "s_acctbal as `cf2:balance`"
    )
    write_sink(wide, {"type": "hbase", "options": cells})
    info = {
        "file_type_input": "parquet",
        "data_sources_params_input": json.dumps({"paths": cells["paths"]}),
        "data_sources_file_columns": "cf1:name,cf2:balance",
        "data_sources_filter_input": "000007",
        "column_data_list": [
            column("row_key", "row_key"),
            column("cf1:upper(name)", "name"),
            column("cf2:cast(balance as double)", "balance"),
        ],
        **file_output(folder + "/out"),
    }
    task = {"dsi_Input": {"data_source_type": "hbase"}, "dsi_Output": HDFS, ETL_BLOCK: info}
    run_etl(spark, task)
    return spark.read.parquet(folder + "/out")


@query(
    "etl_with_function",
    """
    SELECT c_custkey AS id, reverse(c_mktsegment) AS reversed FROM customer
    WHERE length(c_mktsegment) > 8
    """,
)
def etl_with_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function of the caller in the filter and the mapping of a task."""

    def backwards(text: pd.Series) -> pd.Series:
        return text.str[::-1]

    info = parquet_input(
        sf_dir,
        "customer",
        data_sources_filter_input="length(backwards(c_mktsegment)) > 8",
        column_data_list=[column("c_custkey", "id"), column("backwards(c_mktsegment)", "reversed")],
    )
    functions = {"backwards": F.pandas_udf(backwards, "string")}
    return run_etl(spark, {"dsi_Input": HDFS, ETL_BLOCK: info}, functions).frame


@query(
    "sql_dynamic_partition_overwrite",
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT -c_custkey, upper(c_name), c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def sql_dynamic_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL task that replaces one partition of a table."""
    folder = scratch_dir(spark, "overwrite")
    name = f"millrace_overwrite_{folder.rsplit('-', 1)[1]}"
    source = table_path(sf_dir, "customer")
    script = f"""create table {name} (c_custkey bigint, c_name string, c_mktsegment string) using parquet
partitioned by (c_mktsegment) location '{folder}/t';
insert into {name} select c_custkey, c_name, c_mktsegment from parquet.`{source}`;
set spark.sql.sources.partitionOverwriteMode=dynamic;
insert overwrite table {name} select -c_custkey, upper(c_name), c_mktsegment from parquet.`{source}`
where c_mktsegment = 'BUILDING';
select * from {name}"""
    return run_sql(spark, {SQL_BLOCK: {"etl_sql": script}}).frame


@query(
    "map_more_types",
    """
    SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS order_day, o_orderdate AS order_time,
           CAST(coalesce(TRY_CAST(o_orderkey AS TINYINT), -1) AS INTEGER) AS tiny, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS price,
           o_orderstatus = 'F' AS closed, CAST(o_custkey AS VARCHAR) AS customer
    FROM orders
    """,
)
def map_more_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = map_columns(
        table(spark, sf_dir, "orders"),
        [
            column("o_orderkey", "id"),
            column("o_orderdate", "order_day", "date"),
            column("cast(o_orderdate as string)", "order_time", "timestamp_ntz"),
            column("cast(o_orderkey as string)", "tiny", "tinyint"),
            column("o_totalprice", "price", "float"),
            column("if(o_orderstatus = 'F', 'true', 'false')", "closed", "boolean"),
            column("o_custkey", "customer", "string"),
        ],
    )
    tiny = F.coalesce(F.col("tiny").cast("int"), F.lit(-1))
    return mapped.withColumns({"tiny": tiny, "price": F.col("price").cast("double")})
