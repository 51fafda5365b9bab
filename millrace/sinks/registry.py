"""From the type name of a store to its writer."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.modes import save_mode
from millrace.operators.cells import range_sorted, split_points, to_cells
from millrace.operators.keyed import require_key, with_surrogate_key
from millrace.operators.rows import compact
from millrace.operators.transform import ROW_KEY
from millrace.schema import field_names
from millrace.session import apply_options, session_conf
from millrace.sinks.files import write_delivery, write_download, write_files
from millrace.sources import connectors as c
from millrace.sources.files import format_name, full_path, spark_options
from millrace.sources.jdbc import clear_target, write_jdbc
from millrace.sources.tables import write_table

Writer = Callable[[DataFrame, Mapping, "str | None"], object]


def _save(df: DataFrame, link: c.Connection, mode: str) -> None:
    apply_options(df.sparkSession, link.settings)
    writer = df.write.format(link.format).options(**link.options).mode(mode)
    writer.save(link.path) if link.path else writer.save()


def _connector(
    connect: Callable[[Mapping], c.Connection],
    mode: str | None = None,
    reach: Callable[[Mapping], Mapping] | None = None,
) -> Writer:
    """Write through a connector; ``reach`` gives the options to clear the target by JDBC."""

    def write(df, options, clear):
        if clear and clear.strip():
            if not reach:
                raise ValueError("this store cannot be cleared from here; see delete_then_append")
            clear_target(df.sparkSession, reach(options), clear)
        df = compact(df, options.get("merge", -1))
        _save(df, connect(options), mode or save_mode(options.get("model")))

    return write


def key_value(df: DataFrame, key: str = "key", value: str | None = None) -> DataFrame:
    """Two text columns ``key`` and ``value``; without a value column, the row as JSON."""
    body = quoted(value).cast("string") if value else F.to_json(F.struct("*"))
    return df.select(quoted(key).cast("string").alias("key"), body.alias("value"))


def _messages(df, options, clear):
    link = c.kafka_sink(options)
    key_value(df, "key", "value").write.format(link.format).options(**link.options).save()


def _wide_rows(df, options, clear):
    """Cells as files; for a bulk load, sorted inside the given key ranges.

    ``splits`` lists the keys between ranges, or says ``auto:<ranges>`` to cut them from the
    data. Parquet files get a Bloom filter on the key, for scans by key.
    """
    cells = to_cells(df)
    mode = save_mode(options.get("model"))
    if str(options.get("write_mode") or "").lower() == "hfile":
        mode = "overwrite"
        asked = str(options.get("splits") or "")
        if asked.startswith("auto:"):
            splits = split_points(cells, int(asked.removeprefix("auto:")))
        else:
            splits = field_names(asked)
        cells = range_sorted(cells, splits, then_by=("family", "qualifier"))
    else:
        cells = compact(cells, options.get("merge", -1))
    kind = format_name(str(options.get("fileType") or "parquet"))
    not_for_cells = ("sep", "header", "splits", "write_mode", "encoding")
    extra = {k: v for k, v in spark_options(options).items() if k not in not_for_cells}
    if kind == "parquet":
        extra = {f"parquet.bloom.filter.enabled#{ROW_KEY}": "true", **extra}
    cells.write.format(kind).mode(mode).options(**extra).save(full_path(options))


def _elasticsearch(df, options, clear):
    mode = str(options.get("mode") or "") or "errorifexists"
    _save(compact(df, options.get("merge", -1)), c.elasticsearch(options), mode)


def _kudu(df, options, clear):
    if clear and clear.strip():
        raise ValueError("this store cannot be cleared before a load")
    keys = field_names(options.get("primary_key"))
    df = require_key(df, keys) if keys else with_surrogate_key(df)
    _save(compact(df, options.get("merge", -1)), c.kudu(options), "append")


def _read_only(df, options, clear):
    raise ValueError("this store can only be read")


# The type names tasks use.
WRITERS: dict[str, Writer] = {
    "jdbc": write_jdbc,
    "hive": lambda df, options, clear: write_table(df, str(options.get("paths") or ""), options),
    "hdfs": lambda df, options, clear: write_files(df, options),
    "hbase": _wide_rows,
    "es": _elasticsearch,
    "mongodb": _connector(c.mongodb),
    "kafka": _messages,
    "redis": _connector(lambda options: c.redis(options, write=True)),
    "cassandra": _connector(c.cassandra),
    "sftp": lambda df, options, clear: write_delivery(df, options),
    "kudu": _kudu,
    "外部上传": _read_only,
    "外部下载": lambda df, options, clear: write_download(df, options),
    "greenplum": _connector(c.greenplum, "append", dict),
    "tidb": _connector(c.tidb_sink, "append", lambda o: c.jdbc_beside(o, c.TIDB_JDBC)),
    "iceberg": _connector(lambda options: c.iceberg(options, write=True)),
    "ftp": lambda df, options, clear: write_delivery(df, options, text_only=True),
    "http": _read_only,
    "solr": _read_only,
    "flume": _read_only,
    # Writable, though tasks could not name it before.
    "memsql": _connector(c.memsql, None, lambda o: c.jdbc_beside(o, c.MEMSQL_JDBC)),
}


# The types that can run a clear statement before the load.
CLEARABLE = frozenset({"jdbc", "greenplum", "tidb", "memsql"})


def write_sink(df: DataFrame, sink: Mapping) -> object:
    """Write to ``{"type", "options", "clear"}``; an export returns its name.

    A clear statement for a store that cannot run one is refused before anything is
    written: left out, a repeated load would double its rows. ``delete_then_append``, or
    overwriting, does the same there. The store's ``spark.*`` options hold for the write alone.
    """
    kind = str(sink.get("type", "")).strip().lower()
    writer = WRITERS.get(kind)
    if writer is None:
        raise ValueError(f"no sink of type {kind!r}")
    options, clear = sink.get("options", {}), sink.get("clear")
    if clear and clear.strip() and kind not in CLEARABLE:
        raise ValueError(f"a store of type {kind} cannot be cleared before a load; {clear!r} was not run")
    spark = df.sparkSession
    passing = {k: str(v) for k, v in options.items() if k.startswith("spark.") and spark.conf.isModifiable(k)}
    with session_conf(spark, passing):
        return writer(df, options, clear)
