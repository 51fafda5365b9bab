"""Sources and sinks: each query writes through a sink and reads back through a source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.payload import payload_lines, payload_rows
from millrace.queries.base import query, table, table_path
from millrace.schema import schema_frame
from millrace.session import scratch_dir
from millrace.sinks import write_sink
from millrace.sources import read_source
from millrace.sources.tables import overwrite_partitions


def _write(df: DataFrame, path: str, kind: str, sink: str = "hdfs", **options) -> object:
    options = {"paths": path, "fileType": kind, "model": "overwrite", **options}
    return write_sink(df, {"type": sink, "options": options})


def _read(
    spark: SparkSession, path: str, kind: str, fields="", where="", source="hdfs", **options
) -> DataFrame:
    return read_source(
        spark,
        {
            "type": source,
            "options": {"paths": path, "fileType": kind, **options},
            "fields": fields,
            "where": where,
        },
    )


CUSTOMER_TEXT = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           c_mktsegment FROM customer
"""
CUSTOMER_FIELDS = "c_custkey,c_name,c_nationkey,c_mktsegment"


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(*CUSTOMER_FIELDS.split(","))


@query("csv_header_roundtrip", CUSTOMER_TEXT + " WHERE c_mktsegment <> 'BUILDING'")
def csv_header_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "csv") + "/customer"
    _write(_customer(spark, sf_dir), out, "csv", header="true", sep=";", encoding="utf-8")
    return _read(
        spark, out, "csv", where="c_mktsegment <> 'BUILDING'", header="true", sep=";", encoding="utf-8"
    )


@query("csv_field_list_roundtrip", CUSTOMER_TEXT)
def csv_field_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "csv") + "/customer"
    _write(_customer(spark, sf_dir), out, "csv", header="false")
    return _read(spark, out, "csv", CUSTOMER_FIELDS, header="false")


@query(
    "csv_text_documents",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents",
)
def csv_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and every script through delimited files."""
    out = scratch_dir(spark, "csv") + "/documents"
    free_text = {
        "header": "true",
        "multiLine": "true",
        "quoteAll": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "maxCharsPerColumn": "-1",
        "lineSep": "\n",
    }
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    _write(documents, out, "csv", **free_text)
    return _read(spark, out, "csv", **free_text)


@query("tsv_roundtrip", CUSTOMER_TEXT)
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "tsv") + "/customer"
    _write(_customer(spark, sf_dir), out, "csv", sep="\\t")
    return _read(spark, out, "csv", sep="\\t", header="true")


@query(
    "multi_delim_roundtrip",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(NULL AS VARCHAR) AS nothing,
           CASE WHEN p_size > 25 THEN p_brand || '|' || p_type END AS brand_type FROM part
    """,
)
def multi_delim_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "delim") + "/part"
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_name",
        "cast(null as string) as nothing",
        "if(p_size > 25, concat(p_brand, '|', p_type), null) as brand_type",
    )
    _write(part, out, "csv", sep="||")
    return _read(spark, out, "csv", "p_partkey,p_name,nothing,brand_type", sep="||", header="true")


ORDERS_SOME = "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"


@query("orc_roundtrip", ORDERS_SOME)
def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "orc") + "/orders"
    _write(table(spark, sf_dir, "orders"), out, "orc")
    return _read(
        spark,
        out,
        "orc",
        "o_orderkey,o_totalprice,o_orderdate",
        "o_orderdate >= timestamp_ntz '1997-01-01 00:00:00'",
    )


@query("parquet_source", ORDERS_SOME)
def parquet_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(
        spark,
        table_path(sf_dir, "orders"),
        "paquet",
        "o_orderkey,o_totalprice,o_orderdate",
        "o_orderdate >= timestamp_ntz '1997-01-01 00:00:00'",
    )


@query("json_roundtrip", "SELECT doc_id, source, text FROM documents WHERE lang = 'en'")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "json") + "/documents"
    _write(table(spark, sf_dir, "documents"), out, "json")
    schema = "doc_id bigint, source string, text string, lang string"
    fields = "doc_id,source,text,lang"
    return _read(spark, out, "json", fields, "lang = 'en'", schema=schema).drop("lang")


@query("xml_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "xml") + "/supplier"
    _write(table(spark, sf_dir, "supplier"), out, "xml", rowTag="supplier", rootTag="suppliers")
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return _read(spark, out, "xml", rowTag="supplier", schema=schema)


@query("text_lines", "SELECT n_name || ' in ' || n_regionkey AS value FROM nation")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "text") + "/nation"
    _write(
        table(spark, sf_dir, "nation").selectExpr("concat(n_name, ' in ', n_regionkey) as value"),
        out,
        "txt",
    )
    return _read(spark, out, "txt", "value")


@query("uploaded_file", CUSTOMER_TEXT + " WHERE c_nationkey < 10")
def uploaded_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "upload") + "/customer"
    _write(_customer(spark, sf_dir), out, "csv", sep="||", header="true")
    return _read(
        spark,
        out,
        "csv",
        CUSTOMER_FIELDS,
        "cast(c_nationkey as int) < 10",
        "外部上传",
        sep="||",
        header="true",
    )


@query("uploaded_columnar", "SELECT s_suppkey, s_name FROM supplier")
def uploaded_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, table_path(sf_dir, "supplier"), "parquet", "s_suppkey,s_name", source="外部上传")


@query("header_lines_dropped", CUSTOMER_TEXT)
def header_lines_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered text whose files, at least two, each start with the header line."""
    out = scratch_dir(spark, "delivery") + "/customer"
    for half in ("c_nationkey < 10", "c_nationkey >= 10"):
        _write(
            _customer(spark, sf_dir).filter(half), out, "csv", sep="$^", header="true", model="append"
        )
    return _read(spark, out, "csv", CUSTOMER_FIELDS, source="ftp", sep="$^")


@query(
    "delivered_json_lines",
    """
    SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(NULL AS VARCHAR) AS n_comment
    FROM nation WHERE n_regionkey <> 2
    """,
)
def delivered_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "delivery") + "/nation"
    _write(table(spark, sf_dir, "nation"), out, "json")
    fields = "n_nationkey,n_name,n_comment,n_regionkey"
    return _read(spark, out, "json", fields, "n_regionkey <> '2'", "ftp").drop("n_regionkey")


def _per_day(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(where)
        .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "latest_file",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS orders FROM orders GROUP BY 1",
)
def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two summaries are delivered to one folder; only the newer one is read."""
    folder = scratch_dir(spark, "latest")
    for name, where in (("b.csv", "o_orderstatus = 'F'"), ("a.csv", "true")):
        _write(_per_day(spark, sf_dir, where), f"{folder}/{name}", "csv", "sftp", header="true")
    found = _read(spark, folder, "csv", source="sftp", header="true", copyLatest="true")
    return found.select("day", F.col("orders").cast("bigint").alias("orders"))


@query(
    "save_modes",
    """
    SELECT c_custkey, c_name, CAST(2 AS BIGINT) AS copies, 'append' AS mode FROM customer
    UNION ALL SELECT c_custkey, c_name, 1, 'overwrite' FROM customer
    UNION ALL SELECT c_custkey, c_name, 1, 'ignore' FROM customer
    UNION ALL SELECT c_custkey, c_name, 2, 'anything else' FROM customer
    """,
)
def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a row is there after two writes in each mode."""
    folder = scratch_dir(spark, "modes")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    found = []
    for i, mode in enumerate(("append", "overwrite", "ignore", "anything else")):
        for _ in range(2):
            _write(customer, f"{folder}/{i}", "parquet", model=mode)
        found.append(spark.read.parquet(f"{folder}/{i}").withColumn("mode", F.lit(mode)))
    copies = F.count(F.lit(1)).alias("copies")
    return reduce(DataFrame.unionByName, found).groupBy("mode", "c_custkey", "c_name").agg(copies)


@query(
    "partitioned_write",
    "SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders",
)
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "parts") + "/orders"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    _write(
        orders,
        out,
        "parquet",
        partition_by="o_orderstatus,o_orderpriority",
        merge="auto",
    )
    return _read(spark, out, "parquet")


@query(
    "partitioned_delim_write",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
)
def partitioned_delim_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A separator of several characters beside partition columns."""
    out = scratch_dir(spark, "parts") + "/customer"
    _write(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        out,
        "csv",
        sep="~|~",
        partition_by="c_mktsegment",
    )
    return spark.read.schema("c_custkey string, c_name string, c_mktsegment string").csv(
        out, sep="~|~", header=True
    )


@query("single_file_export", "SELECT o_orderkey, o_orderstatus FROM orders")
def single_file_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "single") + "/orders.orc"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    name = _write(orders, out, "orc", is_single="true")
    return spark.read.orc(name)


@query(
    "download_export",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_size > 25 THEN p_name END AS p_name,
           CAST(p_size AS VARCHAR) AS p_size FROM part
    """,
)
def download_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "download")
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "if(p_size > 25, p_name, null) as p_name", "p_size"
    )
    name = write_sink(
        part, {"type": "外部下载", "options": {"root_path": folder, "paths": "part"}}
    )
    return spark.read.csv(name, header=True)


@query("delivery_text_export", CUSTOMER_TEXT)
def delivery_text_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "outbox") + "/customer.txt"
    name = _write(_customer(spark, sf_dir), out, "csv", "ftp", sep="|")
    return spark.read.csv(name, header=True, sep="|")


@query(
    "delivery_quoted_export",
    """SELECT doc_id, source, lang || ',"' || source || '"' AS quoted FROM documents""",
)
def delivery_quoted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "outbox") + "/documents.csv.gz"
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "source", """concat(lang, ',"', source, '"') as quoted"""
    )
    name = _write(
        documents, out, "csv", "sftp", header="true", quote="'", escape="\\", compression="gzip"
    )
    return spark.read.csv(
        name, header=True, quote="'", escape="\\", schema="doc_id bigint, source string, quoted string"
    )


@query(
    "json_payload_rows",
    """
    SELECT user_id, CAST(event_id AS VARCHAR) AS event_id, event_type AS kind,
           json_extract_string(props, '$.k') AS k FROM events
    """,
)
def json_payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched documents, one per event with its rows two levels down."""
    documents = table(spark, sf_dir, "events").selectExpr(
        "user_id",
        """concat('{"status":"ok","data":{"rows":[{"event_id":', event_id, ',"kind":"', event_type,
                  '","props":', props, '}],"total":1}}') as body""",
    )
    return payload_rows(documents, "body", "event_id,kind,props.k", "data.rows", ["user_id"]).select(
        "user_id", "event_id", "kind", "props.k"
    )


@query(
    "json_payload_object",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS kind FROM events WHERE value > 50",
)
def json_payload_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path that holds one object gives one row; an absent path gives none."""
    documents = table(spark, sf_dir, "events").selectExpr(
        """if(value > 50, concat('{"data":{"event_id":', event_id, ',"kind":"', event_type, '"}}'),
              '{"error":"none"}') as body"""
    )
    return payload_rows(documents, "body", "event_id,kind", "data")


@query(
    "csv_payload_rows",
    """
    SELECT doc_id, trim(line) AS line FROM
      (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    """,
)
def csv_payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every text; the separator does not occur."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = payload_lines(documents, "text", "line", "\u0001", ["doc_id"])
    return lines.select("doc_id", F.trim(F.coalesce("line", F.lit(""))).alias("line"))


@query("schema_lookup", """
    SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint', true), (1, 'o_custkey', 'bigint', true),
      (2, 'o_orderstatus', 'string', true), (3, 'o_totalprice', 'double', true),
      (4, 'o_orderdate', 'timestamp_ntz', true), (5, 'o_orderpriority', 'string', true))
      AS t(position, col_name, data_type, nullable)
""")
def schema_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_frame(table(spark, sf_dir, "orders"))


def _new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    folder = scratch_dir(spark, label)
    return f"millrace_{label}_{folder.rsplit('-', 1)[1]}", folder + "/t"


@query(
    "table_insert_by_name",
    """
    SELECT n_name, n_nationkey, n_regionkey FROM nation
    UNION ALL SELECT upper(n_name), n_nationkey + 100, n_regionkey FROM nation
    """,
)
def table_insert_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first write creates the table; the second has its columns in another order."""
    name, path = _new_table(spark, "insert")
    nation = table(spark, sf_dir, "nation")
    first = nation.select("n_name", "n_nationkey", "n_regionkey")
    second = nation.selectExpr(
        "n_regionkey", "n_nationkey + 100 as n_nationkey", "upper(n_name) as n_name"
    )
    for frame in (first, second):
        write_sink(frame, {"type": "hive", "options": {"paths": name, "path": path}})
    return read_source(spark, {"type": "hive", "options": {"tableName": name}})


@query(
    "dynamic_partition_overwrite",
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 0.0, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
    """,
)
def dynamic_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _new_table(spark, "dynamic")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    options = {"paths": name, "path": path, "format": "parquet", "partitionBy": "o_orderstatus"}
    write_sink(orders, {"type": "hive", "options": options})
    corrected = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    overwrite_partitions(corrected, name)
    return read_source(spark, {"type": "hive", "options": {"tableName": name}})


@query(
    "delivered_file_types",
    """
    SELECT p_partkey, p_name, p_retailprice, kind
    FROM part, (SELECT unnest(['csv', 'json', 'orc', 'parquet', 'xml']) AS kind)
    """,
)
def delivered_file_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file in each format a transfer may deliver, read by type and field list."""
    folder = scratch_dir(spark, "delivery")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    found = []
    for kind in ("csv", "json", "orc", "parquet", "xml"):
        extra = {"rowTag": "part", "rootTag": "parts"} if kind == "xml" else {}
        path = str(_write(part, f"{folder}/part.{kind}", kind, "sftp", **extra))
        df = _read(spark, path, kind, ",".join(part.columns), "", "sftp", **extra)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in part.schema]
        found.append(df.select(*typed, F.lit(kind).alias("kind")))
    return reduce(DataFrame.unionByName, found)


@query(
    "fetched_documents_source",
    """
    SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text
    FROM conversations WHERE role = 'user'
    """,
)
def fetched_documents_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that each hold an array of rows at a dotted path, read as a source."""
    folder = scratch_dir(spark, "fetched")
    turn = F.struct("conv_id", "turn", "role", "text")
    reply = F.struct(F.struct(F.array(turn).alias("list")).alias("result"))
    documents = table(spark, sf_dir, "conversations").select(F.to_json(reply).alias("body"))
    documents.write.parquet(folder + "/bodies")
    source = {
        "type": "http",
        "options": {
            "paths": folder + "/bodies",
            "payload_column": "body",
            "fileType": "json",
            "result_column": "result.list",
        },
        "fields": "conv_id,turn,role,text",
        "where": "role = 'user'",
    }
    return read_source(spark, source)


@query(
    "nested_types_roundtrip",
    """
    SELECT vec_id, label, kind, CAST(len(embedding) AS INTEGER) AS size, CAST(embedding[1] AS DOUBLE) AS first_value,
           CAST(embedding[len(embedding)] AS DOUBLE) AS last_value
    FROM embeddings, (SELECT unnest(['orc', 'parquet', 'json']) AS kind)
    """,
)
def nested_types_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array inside a struct through each format that can hold it."""
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
    vector = F.col("data.vector")
    return reduce(DataFrame.unionByName, found).select(
        "vec_id",
        "data.label",
        "kind",
        F.size(vector).alias("size"),
        F.element_at(vector, 1).cast("double").alias("first_value"),
        F.element_at(vector, -1).cast("double").alias("last_value"),
    )
