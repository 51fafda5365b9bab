"""From the type name of a store to its reader."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.cells import row_range, scan_cells
from millrace.operators.payload import payload_lines, payload_rows
from millrace.operators.rows import select_rows
from millrace.schema import field_names, fields_to_schema
from millrace.session import apply_options
from millrace.sources import connectors as c
from millrace.sources.files import (
    format_name,
    full_path,
    read_delivered,
    read_delivered_text,
    read_files,
    read_uploaded,
    spark_options,
)
from millrace.sources.jdbc import read_jdbc
from millrace.sources.tables import read_table

Reader = Callable[[SparkSession, Mapping, Sequence[str], "str | None"], DataFrame]


def _connector(connect: Callable[[Mapping], c.Connection], by_fields: bool = False) -> Reader:
    """Read through a connector; ``by_fields`` gives it the field list as schema."""

    def read(spark, options, fields, where):
        link = connect(options)
        apply_options(spark, link.settings)
        reader = spark.read.format(link.format).options(**link.options)
        if by_fields and fields:
            reader = reader.schema(fields_to_schema(fields))
        return select_rows(reader.load(link.path) if link.path else reader.load(), where)

    return read


def _table(spark, options, fields, where):
    return read_table(spark, str(options.get("tableName") or ""), where)


def _wide_rows(spark, options, fields, where):
    """Cells kept as files of ``row_key, family, qualifier, value``; the filter is a range."""
    start, stop = row_range(where or "")
    kind = format_name(str(options.get("fileType") or "parquet"))
    cells = spark.read.format(kind).options(**spark_options(options)).load(full_path(options))
    return scan_cells(cells, fields, start, stop)


def _fetched(spark, options, fields, where):
    """Documents already fetched, one per row of a text column (``payload_column``)."""
    column = str(options.get("payload_column") or "value")
    kind = format_name(str(options.get("payload_format") or "parquet"))
    documents = spark.read.format(kind).load(full_path(options))
    path = str(options.get("result_column") or "")
    if str(options.get("fileType") or "json").lower() == "csv":
        df = payload_lines(documents, column, fields, str(options.get("sep") or ","))
    else:
        df = payload_rows(documents, column, ",".join(fields), path)
    return select_rows(df, where)


def _sql_table(spark, options, fields, where):
    return spark.sql(c.tidb_query(options, fields, where))


def _write_only(spark, options, fields, where):
    raise ValueError("this store can only be written")


def _streaming(spark, options, fields, where):
    raise ValueError("this store is a stream; read it with ingest_stream")


# The type names tasks use.
READERS: dict[str, Reader] = {
    "jdbc": read_jdbc,
    "hdfs": read_files,
    "hive": _table,
    "hbase": _wide_rows,
    "es": _connector(c.elasticsearch),
    "mongodb": _connector(c.mongodb),
    "kafka": _streaming,
    "http": _fetched,
    "redis": _connector(c.redis, by_fields=True),
    "cassandra": _connector(c.cassandra),
    "sftp": read_delivered,
    "kudu": _connector(c.kudu),
    "外部上传": read_uploaded,
    "flume": _streaming,
    "外部下载": _write_only,
    "greenplum": _connector(c.greenplum),
    "tidb": _sql_table,
    "iceberg": _connector(c.iceberg),
    "ftp": read_delivered_text,
    # Readable, though tasks could not name them before.
    "memsql": _connector(c.memsql),
    "solr": _connector(c.solr),
}
STREAM_TYPES = frozenset({"kafka", "flume"})


def source_frame(
    spark: SparkSession,
    kind: str,
    options: Mapping[str, object],
    fields: str | Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """Read from the store of this type: options, field list and filter."""
    reader = READERS.get(kind.strip().lower())
    if reader is None:
        raise ValueError(f"no source of type {kind!r}")
    apply_options(spark, options)
    return reader(spark, options, field_names(fields), where)


def read_source(spark: SparkSession, source: Mapping) -> DataFrame:
    """Read ``{"type", "options", "fields", "where", "dedup", "order_by"}``."""
    df = source_frame(
        spark,
        str(source.get("type", "")),
        source.get("options", {}),
        source.get("fields"),
        source.get("where"),
    )
    return select_rows(df, None, source.get("dedup"), source.get("order_by"))
