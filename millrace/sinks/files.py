"""File writers and exports under a given file name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted, real_separator
from millrace.modes import save_mode
from millrace.operators.rows import compact
from millrace.schema import field_names
from millrace.sources.connectors import hudi_sink
from millrace.sources.files import format_name, full_path, spark_options


def writer_options(options: Mapping[str, object], kind: str) -> dict[str, str]:
    """Options of the writer; a tab or a long separator means a header unless refused."""
    extra = spark_options(options)
    if kind != "csv":
        return {k: v for k, v in extra.items() if k not in ("sep", "header")}
    sep = real_separator(extra.get("sep", ","))
    extra["sep"] = sep
    if sep == "\t" or len(sep) > 1:
        extra.setdefault("header", "true")
    return extra


def write_files(df: DataFrame, options: Mapping[str, object]) -> str | None:
    """Write files: format, mode, compaction, partitions; or an export by file name."""
    path = full_path(options)
    kind = format_name(options.get("fileType"))
    mode = save_mode(options.get("model"))
    parts = field_names(options.get("partitionBy") or options.get("partition_by"))
    if str(options.get("is_single", "false")).lower() == "true":
        if mode != "overwrite":
            raise ValueError("a single file can only be overwritten")
        if parts:
            raise ValueError("a single file cannot be partitioned")
        return export_file(df, path, kind, writer_options(options, kind))
    df = compact(df, options.get("merge", -1), parts)
    if kind == "hudi":
        link = hudi_sink(options, df.columns, path)
        df.write.format(link.format).options(**link.options).mode(mode).save(link.path)
        return None
    writer = df.write.format(kind).mode(mode).options(**writer_options(options, kind))
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)
    return None


def export_file(
    df: DataFrame, path: str, kind: str = "csv", options: Mapping[str, str] | None = None
) -> str:
    """Write a folder of that name and return it.

    Whatever the size, the export is a folder with a file per partition, each with its
    header if one is asked for, written straight to its place. Spark sizes the files.
    What had the name before is replaced.
    """
    df.hint("rebalance").write.format(kind).mode("overwrite").options(**dict(options or {})).save(path)
    return path


def write_download(df: DataFrame, options: Mapping[str, object]) -> str:
    """A csv to fetch, ``<root_path>/<paths>.csv``: header, NULL text as empty."""
    root = str(options.get("root_path") or "").rstrip("/")
    name = str(options.get("paths") or "").strip("/")
    if not root or not name:
        raise ValueError("a download needs 'root_path' and 'paths'")
    text = df.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    return export_file(text, f"{root}/{name}.csv", "csv", {"header": "true", "emptyValue": ""})


def write_delivery(df: DataFrame, options: Mapping[str, object], text_only: bool = False) -> str:
    """A file for a transfer to pick up: text with a header, or any file type."""
    kind = "csv" if text_only else format_name(options.get("fileType"))
    extra = writer_options(options, kind)
    if kind == "csv" and text_only:
        extra["header"] = "true"
    return export_file(df, full_path(options), kind, extra)
