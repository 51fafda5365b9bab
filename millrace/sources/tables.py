"""Catalog tables: read, insert by name, overwrite partitions, list and describe."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.text import quoted
from millrace.modes import save_mode
from millrace.operators.keyed import merge_in_place
from millrace.operators.rows import compact, select_rows
from millrace.schema import field_names
from millrace.session import session_conf
from millrace.sources.files import spark_options

# Fixed value: the storage of a table a task creates.
DEFAULT_TABLE_FORMAT = "orc"


def read_table(spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
    if not name.strip():
        raise ValueError("a table source needs 'tableName'")
    return select_rows(spark.table(name), where)


def write_table(df: DataFrame, name: str, options: Mapping[str, object] | None = None) -> None:
    """Insert into a table by column name, or create it.

    A new table is ORC unless ``format`` says otherwise, external where ``path`` is
    given, and partitioned by ``partitionBy``.
    """
    options = dict(options or {})
    if not name.strip():
        raise ValueError("a table sink needs 'paths'")
    spark = df.sparkSession
    mode = save_mode(options.get("model"))
    parts = field_names(options.get("partitionBy") or options.get("partition_by"))
    df = compact(df, options.get("merge", -1), parts)
    if spark.catalog.tableExists(name):
        if mode == "ignore":
            return
        if mode == "errorifexists":
            raise ValueError(f"table {name} exists")
        columns = spark.table(name).columns
        df.select(*[quoted(c) for c in columns]).write.insertInto(name, overwrite=mode == "overwrite")
        return
    extra = {k: v for k, v in spark_options(options).items() if k not in ("format", "sep", "header", "encoding")}
    writer = df.write.mode(mode).format(str(options.get("format") or DEFAULT_TABLE_FORMAT))
    if parts:
        writer = writer.partitionBy(*parts)
    writer.options(**extra).saveAsTable(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions of a table that the frame has rows for; others stay."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.select(*[quoted(c) for c in columns]).write.insertInto(name, overwrite=True)


def write_bucketed(df: DataFrame, name: str, keys: str | list[str], buckets: int) -> None:
    """Make a table bucketed and sorted by its key, one file per bucket."""
    names = field_names(keys)
    df.repartition(buckets, *[quoted(key) for key in names]).write.bucketBy(buckets, *names).sortBy(
        *names
    ).format("parquet").saveAsTable(name)


def bucket_layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """The bucket columns of a table and how many buckets it has; none and 0 without."""
    keys = [column.name for column in spark.catalog.listColumns(name) if column.isBucket]
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return keys, int(told.data_type) if told else 0


def upsert_table(df: DataFrame, name: str, precombine: str | list[str]) -> None:
    """Upsert into a table made by ``write_bucketed``, by its bucket columns as record key.

    The next version is joined bucket by bucket and written with the same layout, beside
    the table, and then takes its name; the table itself is not moved by any shuffle. A run
    that ended between the two steps is completed by the next.
    """
    spark, next_name = df.sparkSession, f"{name}__next"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(next_name):
        spark.sql(f"ALTER TABLE {next_name} RENAME TO {name}")
    keys, buckets = bucket_layout(spark, name)
    if not buckets:
        raise ValueError(f"table {name} is not bucketed")
    spark.sql(f"DROP TABLE IF EXISTS {next_name}")
    merged = merge_in_place(spark.table(name), df, keys, precombine, buckets)
    merged.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(next_name)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {next_name} RENAME TO {name}")


def show_databases(spark: SparkSession) -> DataFrame:
    rows = [(db.name,) for db in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "database_name string")


def show_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.name, bool(t.isTemporary)) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, is_temporary boolean")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """``(col_name, data_type, comment)``, partition columns once."""
    rows = [(c.name, c.dataType, c.description) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "col_name string, data_type string, comment string")

