"""Queries over the catalog: what it lists, and what the listed tables hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.queries.base import query, table_path
from millrace.session import scratch_dir
from millrace.sources.tables import describe_table, show_databases, show_tables

LISTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def _database(spark: SparkSession, sf_dir: str) -> str:
    """A database of its own with the given tables in it, where they lie."""
    folder = scratch_dir(spark, "catalog")
    name = f"millrace_catalog_{folder.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    for table in LISTED:
        spark.sql(f"CREATE TABLE {name}.{table} USING parquet LOCATION '{table_path(sf_dir, table)}'")
    return name


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query(
    "catalog_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, false AS is_temporary, CAST(1 AS BIGINT) AS databases, count(*) AS row_count FROM {name}"
        for name in LISTED
    ),
)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that a database lists, each with the rows it holds."""
    database = _database(spark, sf_dir)
    counts = _union(
        [
            spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
            for name in LISTED
        ]
    )
    listed = show_tables(spark, database).where(F.col("table_name").isin(*LISTED) & ~F.col("is_temporary"))
    databases = show_databases(spark).where(F.col("database_name") == database).count()
    return listed.join(counts, "table_name").select(
        "table_name", "is_temporary", F.lit(databases).cast("long").alias("databases"), "row_count"
    )


@query(
    "catalog_columns",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, col_name, filled FROM (
            UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {name}) ON COLUMNS(*) INTO NAME col_name VALUE filled)"""
        for name in LISTED
    ),
)
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column that a table's description lists, with how many of its values are there; a scan per table."""
    database = _database(spark, sf_dir)
    profiles = []
    for name in LISTED:
        columns = [row.col_name for row in describe_table(spark, f"{database}.{name}").collect()]
        filled = spark.table(f"{database}.{name}").agg(*[F.count(quoted(c)).alias(c) for c in columns])
        profiles.append(
            filled.unpivot([], columns, "col_name", "filled").select(F.lit(name).alias("table_name"), "col_name", "filled")
        )
    return _union(profiles)
