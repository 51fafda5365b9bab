"""Quality checks over whole tables; NULLs, which the tables lack, are made with nullif."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import InlineSpec, inline_quality, quality_report, rule_quality
from millrace.queries.base import query, table

KEY = ("l_orderkey", "l_linenumber")


@query(
    "quality_inline_keys",
    """
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (n > 1) AS duplicate_keys,
           CASE WHEN count(*) FILTER (n > 1) > 0 THEN 'fail' ELSE 'pass' END AS key_check,
           greatest(CAST(sum(n) AS DOUBLE) * 0.01, 1.0) AS error_limit,
           CASE WHEN count(*) FILTER (n > 1) = 0 THEN 'pass'
                WHEN count(*) FILTER (n > 1) <= greatest(CAST(sum(n) AS DOUBLE) * 0.01, 1.0) THEN 'within_tolerance'
                ELSE 'fail' END AS result
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    """,
)
def quality_inline_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = inline_quality(table(spark, sf_dir, "lineitem"), InlineSpec(primary_columns=KEY))
    return report.select("total_rows", "duplicate_keys", "key_check", "error_limit", "result")


def _customer_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "nullif(c_mktsegment, 'BUILDING') as segment",
        "nullif(c_nationkey, 3) as nation",
        "if(c_nationkey = 5, null, c_name) as name",
    )


@query(
    "quality_inline_null",
    """
    SELECT count(*) AS total_rows, count(*) FILTER (c_mktsegment = 'BUILDING' OR c_nationkey = 3) AS null_rows,
           'fail' AS null_check, 'fail' AS result FROM customer
    """,
)
def quality_inline_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = InlineSpec(not_null=("segment", "nation"))
    report = inline_quality(_customer_with_nulls(spark, sf_dir), spec)
    return report.select("total_rows", "null_rows", "null_check", "result")


@query(
    "quality_inline_length",
    """
    SELECT count(*) FILTER ((c_mktsegment <> 'BUILDING' AND length(c_mktsegment) <> 9)
                            OR (c_nationkey <> 5 AND length(c_name) <> 18)) AS length_rows,
           'fail' AS length_check FROM customer
    """,
)
def quality_inline_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL has no length and does not count."""
    spec = InlineSpec(lengths={"segment": 9, "name": 18})
    return inline_quality(_customer_with_nulls(spark, sf_dir), spec).select(
        "length_rows", "length_check"
    )


@query(
    "quality_inline_regex",
    """
    SELECT count(*) FILTER (c_nationkey = 5 OR c_mktsegment = 'BUILDING'
             OR NOT regexp_full_match(c_mktsegment, '[A-M]+')) AS regex_rows, 'fail' AS regex_check FROM customer
    """,
)
def quality_inline_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole value must match, and NULL does not."""
    spec = InlineSpec(patterns=(("name", r"Customer#\d+"), ("segment", "[A-M]+")))
    return inline_quality(_customer_with_nulls(spark, sf_dir), spec).select(
        "regex_rows", "regex_check"
    )


@query(
    "quality_inline_url_pattern",
    """
    SELECT count(*) AS total_rows,
           count(*) FILTER (NOT regexp_full_match(url, 'https?://[a-z0-9.-]+/[a-z]{2}/.*')) AS regex_rows
    FROM pages
    """,
)
def quality_inline_url_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = InlineSpec(patterns=(("url", "https?://[a-z0-9.-]+/[a-z]{2}/.*"),))
    return inline_quality(table(spark, sf_dir, "pages"), spec).select("total_rows", "regex_rows")


@query(
    "quality_inline_range",
    """
    SELECT n AS total_rows, CASE WHEN n BETWEEN 1 AND 5000 THEN 'pass' ELSE 'fail' END AS rows_range_check,
           6 AS column_count, 'fail' AS column_count_check, CAST(0 AS BIGINT) AS error_count, 'fail' AS result
    FROM (SELECT count(*) AS n FROM orders)
    """,
)
def quality_inline_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = inline_quality(
        table(spark, sf_dir, "orders"), InlineSpec(rows_range="1-5000", column_size=7)
    )
    return report.select(
        "total_rows",
        "rows_range_check",
        "column_count",
        "column_count_check",
        "error_count",
        "result",
    )


@query(
    "quality_inline_verdict",
    """
    WITH k AS (SELECT count(*) AS n, count(*) FILTER (l_quantity = 50.0) AS nulls,
                      count(*) FILTER (l_quantity <> 50.0 AND l_linenumber = 7 AND l_returnflag = 'R') AS bad
               FROM lineitem GROUP BY l_orderkey, l_linenumber),
         m AS (SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (n > 1) AS duplicate_keys,
                      (SELECT count(*) FROM lineitem WHERE l_quantity = 50.0) AS null_rows,
                      (SELECT count(*) FROM lineitem WHERE NOT regexp_full_match(l_returnflag, '[AN]')) AS regex_rows
               FROM k),
         r AS (SELECT unnest([0.0, 0.5, 1.0]) AS error_rate)
    SELECT error_rate, total_rows, duplicate_keys, null_rows, regex_rows,
           duplicate_keys + null_rows + regex_rows AS error_count,
           CASE WHEN duplicate_keys + null_rows + regex_rows <= greatest(total_rows * error_rate, 1.0)
                THEN 'within_tolerance' ELSE 'fail' END AS result
    FROM m, (SELECT CAST(error_rate AS DOUBLE) AS error_rate FROM r)
    """,
)
def quality_inline_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks at once under three tolerances, each report from one read."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_quantity", F.nullif("l_quantity", F.lit(50.0))
    )
    reports = []
    for rate in (0.0, 0.5, 1.0):
        spec = InlineSpec(
            primary_columns=KEY,
            not_null=("l_quantity",),
            patterns=(("l_returnflag", "[AN]"),),
            column_size=12,
            error_rate=rate,
        )
        reports.append(inline_quality(lines, spec).withColumn("error_rate", F.lit(rate)))
    return reduce(DataFrame.unionByName, reports).select(
        "error_rate",
        "total_rows",
        "duplicate_keys",
        "null_rows",
        "regex_rows",
        "error_count",
        "result",
    )


def _rule(kind: str, code: str, expr: str, columns: str) -> dict[str, str]:
    return {
        "rule_type": kind,
        "rule_code": code,
        "rule_name": f"rule {code}",
        "rule_expr": expr,
        "quality_columns": columns,
    }


@query(
    "quality_rules_regex",
    """
    SELECT 0 AS seq, 'R_1' AS rule_code, 'segment' AS column_name,
           count(*) FILTER (c_mktsegment = 'BUILDING' OR NOT regexp_matches(c_mktsegment, 'M.C')) AS violations
    FROM customer
    UNION ALL SELECT 1, 'R_1', 'name', count(*) FROM customer
    UNION ALL SELECT 2, 'R__2', 'name',
           count(*) FILTER (c_nationkey = 5 OR NOT regexp_matches(c_name, '[13579]$')) FROM customer
    """,
)
def quality_rules_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match anywhere is enough; NULL is a violation."""
    rules = [_rule("2", "R_1", "M.C", "segment,name"), _rule("2", "R__2", "[13579]$", "name")]
    return rule_quality(_customer_with_nulls(spark, sf_dir), rules).select(
        "seq", "rule_code", "column_name", "violations"
    )


@query(
    "quality_rules_sql",
    """
    SELECT 0 AS seq, 'S1' AS rule_code, 'l_quantity' AS column_name,
           count(*) FILTER (l_quantity = 50.0 OR NOT (l_quantity > 0.05)) AS violations FROM lineitem
    UNION ALL SELECT 1, 'S1', 'l_discount', count(*) FILTER (NOT (l_discount > 0.05)) FROM lineitem
    UNION ALL SELECT 2, 'S2', 'l_returnflag', count(*) FILTER (l_returnflag = 'R' AND l_quantity >= 25) FROM lineitem
    """,
)
def quality_rules_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_quantity", F.nullif("l_quantity", F.lit(50.0))
    )
    rules = [
        _rule("1", "S1", "$column > 0.05", "l_quantity,l_discount"),
        _rule(
            "1",
            "S2",
            "not ($column = 'R' and coalesce(l_quantity, 50) >= 25)",
            "l_returnflag",
        ),
    ]
    return rule_quality(lines, rules).select("seq", "rule_code", "column_name", "violations")


@query(
    "quality_rules_key",
    """
    SELECT 0 AS seq, 'K1' AS rule_code, 'l_orderkey,l_linenumber' AS column_name,
           (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM
             (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1) AS violations
    UNION ALL SELECT 1, 'K2', 'l_suppkey',
           (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM
             (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey) WHERE n > 1)
    """,
)
def quality_rules_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts the rows of duplicated keys, where the inline check counts the keys."""
    rules = [
        _rule("3", "K1", "primary_key_check", "l_orderkey,l_linenumber"),
        _rule("3", "K2", "primary_key_check", "l_suppkey"),
    ]
    return rule_quality(table(spark, sf_dir, "lineitem"), rules).select(
        "seq", "rule_code", "column_name", "violations"
    )


@query(
    "quality_report_pass",
    """
    WITH v AS (SELECT (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS k,
                      (SELECT count(*) FROM orders WHERE NOT regexp_matches(o_orderstatus, '^[FOP]$')) AS r)
    SELECT 2 AS seq, 'result' AS rule_code, CAST(NULL AS VARCHAR) AS column_name,
           CAST(CASE WHEN k > 0 THEN 1 ELSE 0 END + CASE WHEN r > 0 THEN 1 ELSE 0 END AS BIGINT) AS violations,
           CASE WHEN k + r > 0 THEN 'fail' ELSE 'pass' END AS message FROM v
    """,
)
def quality_report_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules without a violation are not listed."""
    rules = [
        _rule("3", "K1", "primary_key_check", "o_orderkey"),
        _rule("2", "R1", "^[FOP]$", "o_orderstatus"),
    ]
    report = quality_report(rule_quality(table(spark, sf_dir, "orders"), rules))
    return report.select("seq", "rule_code", "column_name", "violations", "message")


@query(
    "group_sizes",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
