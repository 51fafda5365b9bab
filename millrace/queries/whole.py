"""Whole tables through the sources, sinks and tasks whose other queries read a part of theirs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.plans.jobs import run_apply, run_multi, run_sql
from millrace.queries.base import query, table, table_path
from millrace.queries.etl import (
    APPLY_BLOCK,
    ETL_BLOCK,
    HDFS,
    SQL_BLOCK,
    column,
    file_output,
    multi_task,
    parquet_input,
    run_block,
)
from millrace.queries.files import CUSTOMER_FIELDS, CUSTOMER_TEXT, _customer, _read, _write
from millrace.queries.keyed import SPLITS, _wide
from millrace.schema import schema_frame
from millrace.session import scratch_dir
from millrace.sinks import write_sink
from millrace.sources import read_source


@query("csv_header_whole", CUSTOMER_TEXT)
def csv_header_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "csv") + "/customer"
    _write(_customer(spark, sf_dir), out, "csv", header="true", sep=";", encoding="utf-8")
    return _read(spark, out, "csv", header="true", sep=";", encoding="utf-8")


@query("orc_whole", "SELECT * FROM orders")
def orc_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "orc") + "/orders"
    _write(table(spark, sf_dir, "orders"), out, "orc")
    return _read(spark, out, "orc")


@query("json_whole", "SELECT doc_id, source, lang, text FROM documents")
def json_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of every language."""
    out = scratch_dir(spark, "json") + "/documents"
    _write(table(spark, sf_dir, "documents"), out, "json")
    schema = "doc_id bigint, source string, lang string, text string"
    return _read(spark, out, "json", "doc_id,source,lang,text", schema=schema)


@query("uploaded_whole_file", CUSTOMER_TEXT)
def uploaded_whole_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "upload") + "/customer"
    _write(_customer(spark, sf_dir), out, "csv", sep="||", header="true")
    return _read(spark, out, "csv", CUSTOMER_FIELDS, "", "外部上传", sep="||", header="true")


@query(
    "delivered_whole_json_lines",
    """
    SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
    FROM nation
    """,
)
def delivered_whole_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "delivery") + "/nation"
    _write(table(spark, sf_dir, "nation"), out, "json")
    return _read(spark, out, "json", "n_nationkey,n_name,n_regionkey", "", "ftp")


@query(
    "fetched_documents_whole",
    "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations",
)
def fetched_documents_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of every role."""
    folder = scratch_dir(spark, "fetched")
    turn = F.struct("conv_id", "turn", "role", "text")
    reply = F.struct(F.struct(F.array(turn).alias("list")).alias("result"))
    documents = table(spark, sf_dir, "conversations").select(F.to_json(reply).alias("body"))
    documents.write.parquet(folder + "/bodies")
    options = {
        "paths": folder + "/bodies",
        "payload_column": "body",
        "fileType": "json",
        "result_column": "result.list",
    }
    return read_source(spark, {"type": "http", "options": options, "fields": "conv_id,turn,role,text", "where": ""})


@query("delivery_quoted_text", "SELECT doc_id, source, text FROM documents")
def delivery_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose quotes and line breaks a quoted export has to keep."""
    out = scratch_dir(spark, "outbox") + "/documents.csv.gz"
    quoted = {
        "header": "true",
        "quoteAll": "true",
        "quote": "'",
        "escape": "'",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "lineSep": "\n",
    }
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    name = _write(documents, out, "csv", "sftp", compression="gzip", **quoted)
    schema = "doc_id bigint, source string, text string"
    return spark.read.options(multiLine="true", maxCharsPerColumn="-1", **quoted).schema(schema).csv(name)


@query(
    "nested_types_whole",
    """
    SELECT vec_id, label, kind, CAST(place AS INTEGER) AS place, CAST(embedding[place + 1] AS DOUBLE) AS value
    FROM (SELECT *, unnest(range(len(embedding))) AS place FROM embeddings),
         (SELECT unnest(['orc', 'parquet', 'json']) AS kind)
    """,
)
def nested_types_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of an array inside a struct."""
    folder = scratch_dir(spark, "nested")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.struct("label", F.col("embedding").alias("vector")).alias("data")
    )
    schema = "vec_id bigint, data struct<label:int,vector:array<float>>"
    found = []
    for kind in ("orc", "parquet", "json"):
        _write(vectors, f"{folder}/{kind}", kind)
        df = _read(spark, f"{folder}/{kind}", kind, "vec_id,data", schema=schema)
        found.append(df.withColumn("kind", F.lit(kind)))
    values = reduce(DataFrame.unionByName, found).select(
        "vec_id", "data.label", "kind", F.posexplode("data.vector").alias("place", "value")
    )
    return values.withColumn("value", F.col("value").cast("double"))


@query(
    "bulk_load_order",
    """
    WITH w AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key, * FROM customer),
    cells AS (
        SELECT row_key, 'cf1' AS family, 'Name' AS qualifier, c_name AS value FROM w
        UNION ALL SELECT row_key, 'cf2', 'segment', c_mktsegment FROM w WHERE c_mktsegment <> 'BUILDING'
        UNION ALL SELECT row_key, 'cf1', 'nation', CAST(c_nationkey AS VARCHAR) FROM w
        UNION ALL SELECT row_key, 'cf2', 'mark', 'x' FROM w WHERE c_nationkey <> 3)
    SELECT *, CASE WHEN row_key < '000000200' THEN 0 WHEN row_key < '000000500' THEN 1
           WHEN row_key < '000001000' THEN 2 ELSE 3 END AS range_bucket, true AS ordered
    FROM cells
    """,
)
def bulk_load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell, and whether it stands after the one before it in its file."""
    out = scratch_dir(spark, "bulk") + "/customer"
    options = {"paths": out, "fileType": "parquet", "write_mode": "hfile", "splits": ",".join(SPLITS)}
    write_sink(_wide(spark, sf_dir), {"type": "hbase", "options": options})
    cells = spark.read.parquet(out)
    key = F.struct("range_bucket", "row_key", "family", "qualifier")
    before = F.lag(key).over(Window.partitionBy("file").orderBy("place"))
    cells = cells.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    cells = cells.withColumn("ordered", F.coalesce(before < key, F.lit(True)))
    return cells.select("range_bucket", "row_key", "family", "qualifier", "value", "ordered")


@query(
    "sql_script_whole",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS line_count,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def sql_script_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "sql") + "/summary"
    script = (
        "create temporary view lines using parquet options (path "
        f"'{table_path(sf_dir, 'lineitem')}');\n"
        """select l_returnflag, l_linestatus, count(*) as line_count,
                  cast(sum(cast(l_quantity as decimal(12,2))) as double) as sum_qty
           from lines group by l_returnflag, l_linestatus;"""
    )
    run_sql(spark, {"tli": run_block(), "dsi_Output": HDFS, SQL_BLOCK: {"etl_sql": script, **file_output(out)}})
    return spark.read.parquet(out)


@query(
    "etl_multi_whole",
    """
    SELECT n_name AS nation, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue,
           count(*) AS order_count, count(DISTINCT o_custkey) AS customers, DATE '2024-01-31' AS etl_date
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
def etl_multi_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "multi") + "/revenue"
    task = multi_task(sf_dir, out)
    for source in task["dsi_EtlInfo"]:
        source[ETL_BLOCK]["data_sources_filter_input"] = ""
    run_multi(spark, task)
    return spark.read.parquet(out)


@query("etl_apply_whole", "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def etl_apply_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "apply") + "/supplier"
    names = {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"}
    info = {
        **parquet_input(sf_dir, "supplier"),
        **file_output(out, "orc"),
        "column_data_list": [column(name, alias) for name, alias in names.items()],
    }
    run_apply(spark, {"tli": run_block(), "dsi_Input": HDFS, "dsi_Output": HDFS, APPLY_BLOCK: info})
    return spark.read.orc(out)


_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "schema_lookup_rows",
    "SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint', true), (1, 'o_custkey', 'bigint', true), "
    "(2, 'o_orderstatus', 'string', true), (3, 'o_totalprice', 'double', true), "
    "(4, 'o_orderdate', 'timestamp_ntz', true), (5, 'o_orderpriority', 'string', true)) "
    "AS t(position, col_name, data_type, nullable) JOIN ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS col_name, count({name}) AS filled, count(DISTINCT {name}) AS kinds FROM orders"
        for name in _ORDERS
    )
    + ") USING (col_name)",
)
def schema_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema beside what the rows hold in each of its columns."""
    orders = table(spark, sf_dir, "orders")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for c in orders.columns]))
    held = orders.select(cells.alias("cell")).select("cell.*").groupBy("col_name", "value").agg(F.count("value").alias("n"))
    held = held.groupBy("col_name").agg(F.sum("n").alias("filled"), F.count("value").alias("kinds"))
    return schema_frame(orders).join(held, "col_name")
