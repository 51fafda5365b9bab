"""Streams: events are delivered as message files and ingested into a batch sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.jobs import ETL_BLOCK, run_etl
from millrace.queries.base import query, table
from millrace.session import scratch_dir
from millrace.streaming.ingest import ingest_stream

# In use, a topic; here, a folder of message files read to its end.
JSON_FIELDS = "event.id,event.kind,user_id,ts,value"
JSON_MAPPING = [
    {"column_expr": "cast(event.id as bigint)", "column_alias": "event_id"},
    {"column_expr": "event.kind", "column_alias": "event_type"},
    {"column_expr": "cast(user_id as bigint)", "column_alias": "user_id"},
    {"column_expr": "cast(ts as timestamp_ntz)", "column_alias": "ts"},
    {"column_expr": "cast(value as double)", "column_alias": "value"},
]


def _json_messages(events: DataFrame) -> DataFrame:
    return events.select(
        F.to_json(
            F.struct(
                F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")).alias("event"),
                "user_id",
                F.col("ts").cast("string").alias("ts"),
                "value",
            )
        ).alias("value")
    )


def _csv_messages(events: DataFrame, sep: str) -> DataFrame:
    return events.select(F.concat_ws(sep, "event_id", "event_type", "user_id").alias("value"))


def _run(spark: SparkSession, folder: str, fields: str, mapping=None, where="", **options) -> str:
    """Ingest what is in ``in`` and return the folder of the sink."""
    out = folder + "/out"
    ingest_stream(
        spark,
        {
            "type": "flume",
            "options": {"paths": folder + "/in", "checkpoint": folder + "/progress", **options},
            "fields": fields,
            "mapping": mapping,
            "where": where,
            "once": True,
        },
        {"type": "hdfs", "options": {"paths": out, "fileType": "parquet", "batch_path": True}},
    ).awaitTermination()
    return out


@query(
    "stream_json_ingest",
    "SELECT event_id, event_type, user_id, ts, value FROM events WHERE event_type <> 'error'",
)
def stream_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "stream")
    _json_messages(table(spark, sf_dir, "events")).write.text(folder + "/in")
    out = _run(spark, folder, JSON_FIELDS, JSON_MAPPING, "event_type <> 'error'", msgType="json")
    return spark.read.parquet(out).drop("batch_id")


@query(
    "stream_csv_ingest",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id,
           CAST(NULL AS VARCHAR) AS absent FROM events
    """,
)
def stream_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by position, trimmed; a field the message lacks is NULL."""
    folder = scratch_dir(spark, "stream")
    _csv_messages(table(spark, sf_dir, "events"), " || ").write.text(folder + "/in")
    out = _run(spark, folder, "event_id,event_type,user_id,absent", sep="||")
    return spark.read.parquet(out).drop("batch_id")


@query(
    "stream_restart",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id,
           CAST(1 AS BIGINT) AS copies FROM events
    """,
)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, new files before the second: every message arrives once."""
    folder = scratch_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    fields = "event_id,event_type,user_id"
    out = ""
    for part in (events.filter("value < 20"), events.filter("not value < 20"), None):
        if part is not None:
            _csv_messages(part, "|").write.mode("append").text(folder + "/in")
        out = _run(spark, folder, fields, sep="|")
    return (
        spark.read.parquet(out)
        .groupBy("event_id", "event_type", "user_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@query(
    "stream_into_table",
    """
    SELECT CAST(event_id AS BIGINT) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events
    """,
)
def stream_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages into a catalog table, created by the first batch."""
    folder = scratch_dir(spark, "stream")
    name = f"millrace_stream_{folder.rsplit('-', 1)[1]}"
    _csv_messages(table(spark, sf_dir, "events"), ",").write.text(folder + "/in")
    source = {
        "type": "flume",
        "options": {"paths": folder + "/in", "checkpoint": folder + "/progress"},
        "fields": "event_id,event_type,user_id",
        "once": True,
    }
    sink = {"type": "hive", "options": {"paths": name, "path": folder + "/table"}}
    ingest_stream(spark, source, sink).awaitTermination()
    return spark.table(name).withColumn("event_id", F.col("event_id").cast("bigint"))


@query(
    "etl_stream_source",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, upper(event_type) AS kind, '2024-01-31' AS etl_date FROM events
    WHERE event_type <> 'view'
    """,
)
def etl_stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single-source task whose source is a stream of JSON messages."""
    folder = scratch_dir(spark, "stream")
    _json_messages(table(spark, sf_dir, "events")).write.text(folder + "/in")
    source = {"msgType": "json", "checkpoint": folder + "/progress", "once": "true"}
    task = {
        "tli": {"job_id": folder.rsplit("-", 1)[1], "params": '{"ETL_DATE": "2024-01-31"}'},
        "dsi_Input": {"data_source_type": "flume", "paths": folder + "/in"},
        "dsi_Output": {"data_source_type": "hdfs", "paths": folder + "/out", "batch_path": True},
        ETL_BLOCK: {
            "data_sources_file_columns": JSON_FIELDS,
            "data_sources_params_input": source,
            "data_sources_filter_input": "kind <> 'VIEW'",
            "column_data_list": [
                {"column_expr": "event.id", "column_alias": "event_id"},
                {"column_expr": "upper(event.kind)", "column_alias": "kind"},
                {"column_expr": "$etl_date", "column_alias": "etl_date"},
            ],
            "file_type_output": "parquet",
        },
    }
    run_etl(spark, task).stream.awaitTermination()
    return spark.read.parquet(folder + "/out").drop("batch_id")
