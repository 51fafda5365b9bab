"""Functions tasks use in their expressions."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import full_match, line_fields
from millrace.operators.transform import map_columns
from millrace.queries.base import query, table


@query(
    "delimiter_escape",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment, sep FROM customer,
      (SELECT unnest(['|', '||', '.', '$^', '*+', '[]', '{}', '()', '-', '?', '/', '\\']) AS sep)
    """,
)
def delimiter_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every separator is taken as it is written.

    One branch of a union per separator: each has its own tasks, and code short enough to compile.
    """
    customers = table(spark, sf_dir, "customer")
    versions = []
    for sep in ("|", "||", ".", "$^", "*+", "[]", "{}", "()", "-", "?", "/", "\\"):
        line = F.concat_ws(sep, "c_custkey", "c_name", "c_mktsegment")
        fields = line_fields(line, sep, ["id", "name", "segment"])
        versions.append(customers.select(*fields, F.lit(sep).alias("sep")))
    return reduce(DataFrame.unionByName, versions)


@query(
    "string_functions",
    """
    SELECT p_partkey, concat_ws('_', p_name, p_brand) AS joined, CAST(length(p_name) AS INTEGER) AS name_length,
           regexp_matches(p_name, 'ring|widget') AS is_match, trim(' ' || p_name || ' ') AS trimmed,
           md5(p_name || p_brand) AS digest, split_part(p_name, ' ', 2) AS second_word,
           regexp_full_match(p_brand, 'Brand#1\\d*') AS brand_one
    FROM part
    """,
)
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws("_", "p_name", "p_brand").alias("joined"),
        F.length("p_name").alias("name_length"),
        F.col("p_name").rlike("ring|widget").alias("is_match"),
        F.trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("trimmed"),
        F.md5(F.concat("p_name", "p_brand")).alias("digest"),
        F.coalesce(F.get(F.split("p_name", " "), F.lit(1)), F.lit("")).alias("second_word"),
        full_match(F.col("p_brand"), r"Brand#1\d*").alias("brand_one"),
    )


@query(
    "map_array_functions",
    """
    SELECT s_suppkey, s_name AS by_key, CAST(s_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS absent,
           CAST(2 AS INTEGER) AS entries, s_name AS first_value FROM supplier
    """,
)
def map_array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row as a map from column name to text."""
    keys = F.array(F.lit("name"), F.lit("nation"))
    values = F.array(F.col("s_name"), F.col("s_nationkey").cast("string"))
    row = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.map_from_arrays(keys, values).alias("m"), values.alias("v")
    )
    return row.select(
        "s_suppkey",
        F.col("m")["name"].alias("by_key"),
        F.try_element_at("m", F.lit("nation")).alias("nation"),
        F.try_element_at("m", F.lit("other")).alias("absent"),
        F.size("m").alias("entries"),
        F.get("v", F.lit(0)).alias("first_value"),
    )


@query(
    "conditional_functions",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'ok' END AS state,
           c_mktsegment = 'BUILDING' AS no_segment,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment,
           c_custkey % 7 AS remainder, CAST(c_custkey * 2 - 1 AS BIGINT) AS odd
    FROM customer
    """,
)
def conditional_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    balance = F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .select(
            "c_custkey",
            F.when(balance < 0, "debt").when(balance < 1000, "low").otherwise("ok").alias("state"),
            segment.isNull().alias("no_segment"),
            segment.alias("segment"),
            F.expr("c_custkey % 7").alias("remainder"),
            F.expr("c_custkey * 2 - 1").alias("odd"),
        )
        .na.fill("", ["segment"])
    )


@query(
    "udf_in_mapping",
    """
    SELECT p_partkey AS id, replace(p_brand, 'Brand#', 'B') || '-' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS code
    FROM part
    """,
)
def udf_in_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered Arrow function is callable from a mapping by name.

    It is defined here, not in the module, so that Spark ships it by value and the
    executors do not need this package.
    """

    def code(brand: pd.Series, size: pd.Series) -> pd.Series:
        return brand.str.replace("Brand#", "B", regex=False) + "-" + size.astype("string").str.zfill(3)

    spark.udf.register("brand_code", F.pandas_udf(code, "string"))
    return map_columns(
        table(spark, sf_dir, "part"),
        [
            {"column_expr": "p_partkey", "column_alias": "id"},
            {"column_expr": "brand_code(p_brand, p_size)", "column_alias": "code"},
        ],
    )
