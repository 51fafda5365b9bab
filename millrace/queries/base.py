"""Registry of queries and helpers they share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL to compare it with."""

    def register(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} exists")
        REGISTRY[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table_path(sf_dir: str, name: str) -> str:
    root = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    return f"{root.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
