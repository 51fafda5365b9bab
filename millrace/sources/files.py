"""File readers: delimited text, ORC, Parquet, JSON, XML and any other Spark format."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import line_fields, quoted, real_separator
from millrace.operators.rows import select_rows
from millrace.operators.transform import rename_all, select_fields
from millrace.schema import field_names, fields_to_schema, text_schema
from millrace.session import hadoop_path

# Spellings of a file type, and the packages behind two of them.
EXCEL_FORMAT = "com.crealytics.spark.excel"
FORMAT_NAMES = {
    "paquet": "parquet",
    "txt": "text",
    "excel": EXCEL_FORMAT,
    "xls": EXCEL_FORMAT,
    "xlsx": EXCEL_FORMAT,
}

# Keys of a task that address a store or steer the task; Spark's readers and writers
# do not get them.
TASK_KEYS = frozenset(
    """
    id data_source_type data_source_context url user password paths file_type fileType merge
    model partition_by partitionBy repartition_num repartition_cols primary is_single
    copyLatest root_path inputCols host port username fields
    """.split()
)


def format_name(file_type: str | None) -> str:
    name = (file_type or "csv").strip().lower()
    return FORMAT_NAMES.get(name, name)


def spark_options(options: Mapping[str, object]) -> dict[str, str]:
    """The options a Spark reader or writer takes."""
    return {
        key: str(value)
        for key, value in options.items()
        if key not in TASK_KEYS and not key.startswith("spark.") and value is not None
    }


def full_path(options: Mapping[str, object]) -> str:
    """``paths``, below ``url`` where that is given; it must be absolute."""
    path = str(options.get("paths") or "").strip()
    if not path:
        raise ValueError("a file store needs 'paths'")
    if "://" in path or path.startswith("file:/"):
        return path
    if not path.startswith("/"):
        raise ValueError(f"path {path!r} must be absolute")
    url = str(options.get("url") or "")
    if "," in url:
        raise ValueError(f"address {url!r} must name one file system, not the nodes that know it")
    return url.rstrip("/") + path


def read_files(
    spark: SparkSession,
    options: Mapping[str, object],
    fields: str | Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """Read files by ``fileType``, keep the listed fields, then filter."""
    path = full_path(options)
    kind = format_name(options.get("fileType"))
    extra = spark_options(options)
    schema = extra.pop("schema", None)
    if kind == "csv":
        df = read_delimited(spark, path, extra, fields, schema)
    elif kind == EXCEL_FORMAT:
        df = rename_all(spark.read.format(kind).options(**extra).load(path), fields)
    else:
        df = read_format(spark, path, kind, extra, fields, schema)
    return select_rows(df, where)


def read_delimited(
    spark: SparkSession,
    path: str,
    options: Mapping[str, str] | None = None,
    fields: str | Sequence[str] | None = None,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Delimited text.

    With a header and a one-character separator, or a tab spelled ``\\t``, the columns are
    those of the file, whatever the field list. Otherwise they are the field list: all
    text, a short line ends in NULLs, and the separator is taken literally however long
    it is. A ``schema`` settles names and types for either.
    """
    extra = dict(options or {})
    spelled = extra.pop("sep", ",")
    sep = real_separator(spelled)
    names = field_names(fields)
    header = extra.get("header", "false").lower() == "true"
    reader = spark.read.options(**extra)
    if schema:
        reader = reader.schema(schema)
    elif not (header and len(sep) == 1) and spelled != "\\t":
        if names:
            reader = reader.schema(text_schema(names))
        elif not header:
            raise ValueError(f"text separated by {sep!r} without a header needs its field list")
    return reader.csv(path, sep=sep)


def read_format(
    spark: SparkSession,
    path: str,
    kind: str,
    options: Mapping[str, str] | None = None,
    fields: str | Sequence[str] | None = None,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Any format Spark reads, reduced to the listed fields.

    Without a ``schema`` Spark reads JSON and XML twice, first for their types.
    """
    extra = {key: value for key, value in (options or {}).items() if key not in ("sep", "header")}
    if kind == "hudi":
        path = path.rstrip("/") + "/*"
    reader = spark.read.format(kind).options(**extra)
    if schema:
        reader = reader.schema(schema)
    return select_fields(reader.load(path), fields)


def read_uploaded(
    spark: SparkSession,
    options: Mapping[str, object],
    fields: str | Sequence[str],
    where: str | None = None,
) -> DataFrame:
    """An uploaded file: text formats get the field list as schema, ORC and Parquet by name."""
    path = full_path(options)
    kind = format_name(options.get("fileType"))
    extra = spark_options(options)
    if kind in ("orc", "parquet"):
        df = read_format(spark, path, kind, extra, fields)
    else:
        if "sep" in extra:
            extra["sep"] = real_separator(extra["sep"])
        df = spark.read.format(kind).schema(fields_to_schema(fields)).options(**extra).load(path)
    return select_rows(df, where)


def read_delivered_text(
    spark: SparkSession,
    options: Mapping[str, object],
    fields: str | Sequence[str],
    where: str | None = None,
) -> DataFrame:
    """Delivered lines by field list: delimited, or JSON objects.

    Delimited lines whose first field is its own name are headers and dropped, wherever
    they stand; so are lines without a first field.
    """
    names = field_names(fields)
    if not names:
        raise ValueError("delivered text needs its field list")
    lines = spark.read.text(full_path(options))
    if format_name(options.get("fileType")) == "json":
        parsed = F.from_json("value", fields_to_schema(names)).alias("data")
        return select_rows(lines.select(parsed).select("data.*"), where)
    df = lines.select(*line_fields(F.col("value"), str(options.get("sep") or ","), names))
    return select_rows(df.filter(quoted(names[0]) != names[0]), where)


def read_delivered(
    spark: SparkSession,
    options: Mapping[str, object],
    fields: str | Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """A file a transfer has put in place; with ``copyLatest`` the newest of a folder.

    A field list names the columns of text, whether or not it has a header line, and is
    the schema of JSON and XML, all text; of other formats it picks columns by name.
    """
    names = field_names(fields)
    path = full_path(options)
    kind = format_name(options.get("fileType"))
    extra = spark_options(options)
    schema = extra.pop("schema", None)
    if str(options.get("copyLatest", "false")).lower() == "true":
        path = newest_file(spark, path)
    if kind == "csv":
        listed = text_schema(names) if names else None
        df = read_delimited(spark, path, extra, names, schema or listed)
    elif kind in ("json", "xml"):
        listed = fields_to_schema(names) if names else None
        df = read_format(spark, path, kind, extra, (), schema or listed)
    elif kind in ("text", EXCEL_FORMAT):
        df = rename_all(read_format(spark, path, kind, extra), names)
    else:
        df = read_format(spark, path, kind, extra, names)
    return select_rows(df, where)


def newest_file(spark: SparkSession, path: str) -> str:
    """What changed last in a folder: a file, or an export of several files in a folder.

    Of several that changed at once it is the one last by name. Only file names and times
    are read, and one name comes back.
    """
    store, folder = hadoop_path(spark, path)
    root = store.makeQualified(folder).toString().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    entry = F.substring_index(F.expr(f"substring(path, {len(root) + 1})"), "/", 1)
    changed = files.groupBy(entry.alias("entry")).agg(F.max("modificationTime").alias("changed"))
    newest = changed.orderBy(F.desc("changed"), F.desc("entry")).first()
    if newest is None:
        raise ValueError(f"no file in {path}")
    return root + newest["entry"]
