"""Gates, rule lists, chained rules, rejects, shared views, layouts and batch ledgers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import rule_quality
from millrace.operators.rules import apply_rules
from millrace.operators.windows import top_per_group
from millrace.plans.jobs import ETL_BLOCK, SQL_BLOCK, run_etl, run_sql
from millrace.queries.base import query, table, table_path
from millrace.queries.etl import HDFS, column, file_output, parquet_input, run_block
from millrace.session import scratch_dir
from millrace.sources.tables import upsert_table, write_bucketed
from millrace.streaming.ingest import batch_writer, ingest_stream


@query(
    "etl_gate_without_key",
    """
    SELECT l_orderkey AS id, l_quantity AS quantity, n AS total_rows, CAST(0 AS BIGINT) AS null_rows,
           bad AS regex_rows, 'within_tolerance' AS result
    FROM lineitem, (SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS bad FROM lineitem)
    """,
)
def etl_gate_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row checks of a load are counted by the write of its gated copy."""
    info = {
        **parquet_input(sf_dir, "lineitem"),
        "enable_quality": "on",
        "error_rate": "1.0",
        "column_data_list": [
            column("l_orderkey", "id", column_name="l_orderkey", column_is_null="false"),
            column("l_quantity", "quantity", column_name="l_returnflag", column_regex="[AN]"),
        ],
    }
    done = run_etl(spark, {"tli": run_block(), "dsi_Input": HDFS, ETL_BLOCK: info})
    told = {name: F.lit(done.quality[name]).cast("bigint") for name in ("total_rows", "null_rows", "regex_rows")}
    told["result"] = F.lit(done.quality["result"])
    return done.frame.withColumns(told)


@query(
    "quality_rules_many",
    """
    WITH l AS (SELECT *, nullif(l_linenumber, 7) AS line, nullif(l_returnflag, 'R') AS flag FROM lineitem),
    k AS (SELECT coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n FROM (SELECT count(*) AS n FROM l GROUP BY l_orderkey, line)),
    m AS (SELECT coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n FROM (SELECT count(*) AS n FROM l GROUP BY line, flag)),
    o AS (SELECT coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n FROM (SELECT count(*) AS n FROM l GROUP BY l_orderkey))
    SELECT 0 AS seq, 'K1' AS rule_code, 'l_orderkey,line' AS column_name, (SELECT n FROM k) AS violations
    UNION ALL SELECT 1, 'K2', 'line,flag', (SELECT n FROM m)
    UNION ALL SELECT 2, 'K3', 'l_orderkey', (SELECT n FROM o)
    UNION ALL SELECT 3, 'S1', 'line', count(*) FILTER (line IS NULL OR line > 3) FROM l
    UNION ALL SELECT 4, 'S1', 'l_quantity', count(*) FILTER (l_quantity > 3) FROM l
    UNION ALL SELECT 5, 'R1', 'flag', count(*) FILTER (flag IS NULL OR flag <> 'A') FROM l
    """,
)
def quality_rules_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three key rules, an SQL rule and a pattern in one scan; NULLs are key values."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "*", "nullif(l_linenumber, 7) as line", "nullif(l_returnflag, 'R') as flag"
    )

    def rule(kind: str, code: str, expr: str, columns: str) -> dict[str, str]:
        return {"rule_type": kind, "rule_code": code, "rule_name": code, "rule_expr": expr, "quality_columns": columns}

    rules = [
        rule("2", "R1", "^A$", "flag"),
        rule("1", "S1", "$column <= 3", "line,l_quantity"),
        rule("3", "K1", "primary_key_check", "l_orderkey,line"),
        rule("3", "K2", "primary_key_check", "line,flag"),
        rule("3", "K3", "primary_key_check", "l_orderkey"),
    ]
    return rule_quality(lines, rules).select("seq", "rule_code", "column_name", "violations")


@query(
    "sql_script_shared_view",
    """
    WITH p AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    SELECT o_orderkey, o_custkey, n, o_totalprice = top AS is_top
    FROM orders JOIN p USING (o_custkey) WHERE o_orderstatus <> 'P' AND o_totalprice >= top
    """,
)
def sql_script_shared_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view joined with its own aggregate; it is evaluated once."""
    script = (
        f"create temporary view stored using parquet options (path '{table_path(sf_dir, 'orders')}');\n"
        "create or replace temporary view live as select * from stored where o_orderstatus <> 'P';\n"
        "select o_orderkey, l.o_custkey, n, o_totalprice = top as is_top from live l join "
        "(select o_custkey, count(*) as n, max(o_totalprice) as top from live group by o_custkey) p "
        "on l.o_custkey = p.o_custkey where o_totalprice >= top"
    )
    return run_sql(spark, {"tli": run_block(), SQL_BLOCK: {"etl_sql": script}}).frame


PRIORITY_RULES = [
    {"priority": 9, "when": "tier = 'gold'", "set": {"handling": "'express'"}},
    {"priority": 9, "when": "status = 'F'", "set": {"handling": "concat(coalesce(handling, ''), '+closed')"}},
    {"priority": 5, "when": "cast(price as double) >= 250000", "set": {"tier": "'gold'"}},
    {"priority": 7, "when": "cast(price as double) >= 100000", "set": {"tier": "'silver'"}},
    {"when": "tier is null", "set": {"tier": "'none'", "checked": "id"}},
]


@query(
    "rules_priority",
    """
    WITH s AS (
        SELECT o_orderkey, o_orderstatus, o_totalprice,
            CASE WHEN o_totalprice >= 250000 THEN 'gold' WHEN o_totalprice >= 100000 THEN 'silver' ELSE 'none' END AS tier
        FROM orders)
    SELECT CASE WHEN tier = 'none' THEN CAST(o_orderkey AS VARCHAR) END AS checked,
           CASE WHEN tier = 'gold' AND o_orderstatus = 'F' THEN 'express+closed' WHEN tier = 'gold' THEN 'express'
                WHEN o_orderstatus = 'F' THEN '+closed' END AS handling,
           CAST(o_orderkey AS VARCHAR) AS id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
           o_orderstatus AS status, tier
    FROM s
    """,
)
def rules_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of low priority enables one that was due, and had not fired, before it."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id", "cast(o_totalprice as decimal(12,2)) as price", "o_orderstatus as status"
    )
    return apply_rules(orders, PRIORITY_RULES)


@query(
    "etl_with_rejects",
    """
    SELECT 'accepted' AS kind, CAST(l_orderkey AS VARCHAR) AS id, CAST(l_linenumber AS VARCHAR) AS line,
           CAST(NULL AS VARCHAR) AS reason FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber <> 7
    UNION ALL
    SELECT 'rejected', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
           concat_ws('; ', CASE WHEN l_linenumber = 7 THEN 'line: seven is no int' END,
                     CASE WHEN l_returnflag = 'R' THEN 'flagged: R is no date' END)
    FROM lineitem WHERE l_returnflag = 'R' OR l_linenumber = 7
    """,
)
def etl_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that do not fit their type send a row to the store of rejects, with reasons."""
    folder = scratch_dir(spark, "rejects")
    table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "if(l_linenumber = 7, 'seven', cast(l_linenumber as string)) as line_text",
        "l_linenumber",
        "if(l_returnflag = 'R', 'R', '2024-01-31') as flag",
    ).write.parquet(folder + "/in")
    info = {
        "file_type_input": "parquet",
        "data_sources_params_input": json.dumps({"paths": folder + "/in"}),
        **file_output(folder + "/out"),
        "column_data_list": [
            column("l_orderkey", "id", "string"),
            column("line_text", "line", "int"),
            column("flag", "flagged", "date"),
        ],
    }
    rejects = {"data_source_type": "hdfs", "paths": folder + "/rejects"}
    run_etl(spark, {"tli": run_block(), "dsi_Input": HDFS, "dsi_Output": HDFS, "dsi_Reject": rejects, ETL_BLOCK: info})
    accepted = spark.read.parquet(folder + "/out").select(
        F.lit("accepted").alias("kind"), "id", F.col("line").cast("string").alias("line"), F.lit(None).cast("string").alias("reason")
    )
    row = F.from_json("rejected_row", "l_orderkey string, l_linenumber string")
    rejected = spark.read.parquet(folder + "/rejects").select(
        F.lit("rejected").alias("kind"),
        row["l_orderkey"].alias("id"),
        row["l_linenumber"].alias("line"),
        F.array_join("reject_reasons", "; ").alias("reason"),
    )
    return accepted.unionByName(rejected)


@query(
    "stream_with_rejects",
    """
    SELECT event_id, CASE WHEN value IS NULL THEN 'no' ELSE 'yes' END AS has_value, NULL::VARCHAR AS reason FROM events
    WHERE event_type NOT IN ('error', 'view') AND event_id % 10 <> 3
    UNION ALL SELECT event_id, NULL, 'value: none is no double' FROM events WHERE event_type = 'view' AND event_id % 10 <> 3
    UNION ALL SELECT event_id, NULL, 'the message is no JSON object' FROM events WHERE event_id % 10 = 3
    """,
)
def stream_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken messages and values of another type, out of a stream; the filter drops good rows alone."""
    folder = scratch_dir(spark, "stream")
    message = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.expr("if(event_type = 'view', 'none', cast(value as string))").alias("value")))
    broken = F.concat(F.lit("<"), F.col("event_id"), F.lit(">"))
    events = table(spark, sf_dir, "events")
    events.select(F.when(F.col("event_id") % 10 == 3, broken).otherwise(message).alias("value")).write.text(folder + "/in")
    sinks = [{"type": "hdfs", "options": {"paths": f"{folder}/{name}", "fileType": "parquet", "batch_path": True}} for name in ("out", "rejects")]
    source = {
        "type": "flume",
        "options": {"paths": folder + "/in", "checkpoint": folder + "/progress", "msgType": "json"},
        "fields": "id,kind,value",
        "mapping": [column("id", "event_id", "bigint"), column("kind", "kind"), column("value", "value", "double")],
        "where": "kind <> 'error'",
        "once": True,
        "rejects": sinks[1],
    }
    ingest_stream(spark, source, sinks[0]).awaitTermination()
    accepted = spark.read.parquet(folder + "/out").select(
        "event_id", F.expr("if(value is null, 'no', 'yes')").alias("has_value"), F.lit(None).cast("string").alias("reason")
    )
    rejected = spark.read.parquet(folder + "/rejects").select(
        F.regexp_extract("rejected_row", r"\d+", 0).cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("has_value"),
        F.array_join("reject_reasons", "; ").alias("reason"),
    )
    return accepted.unionByName(rejected)


@query(
    "stream_batches_once",
    """
    SELECT event_id, event_type, CAST(CASE WHEN value < 20 THEN 0 ELSE 1 END AS BIGINT) AS batch, CAST(1 AS BIGINT) AS copies
    FROM events
    """,
)
def stream_batches_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches reach the table twice, as after a failure, and stay in it once."""
    folder = scratch_dir(spark, "ledger")
    name = f"millrace_ledger_{folder.rsplit('-', 1)[1]}"
    options = {"paths": name, "path": folder + "/table", "format": "parquet", "batch_partition": "batch"}
    write = batch_writer({"type": "hive", "options": options})
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for number in (0, 1, 0, 1):
        part = events.where("value < 20") if number == 0 else events.where("not value < 20")
        write(part.drop("value"), number)
    return spark.table(name).groupBy("event_id", "event_type", "batch").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "upsert_bucketed_table",
    """
    SELECT o_orderkey AS uuid, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS ts FROM orders
    UNION ALL SELECT -1 - c_custkey, 'new', TIMESTAMP '2000-01-01 00:00:00' FROM customer
    """,
)
def upsert_bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes, stale repeats and new keys into a table that keeps its buckets."""
    name = f"millrace_upsert_{scratch_dir(spark, 'upsert').rsplit('-', 1)[1]}"
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as uuid", "o_orderstatus as status", "o_orderdate as ts")
    write_bucketed(orders, name, "uuid", 8)
    changed = orders.where("status <> 'P'").selectExpr(
        "uuid",
        "if(status = 'F', 'closed', 'stale') as status",
        "if(status = 'F', ts + interval 1 day, ts - interval 1 day) as ts",
    )
    new = table(spark, sf_dir, "customer").selectExpr(
        "-1 - c_custkey as uuid", "'new' as status", "timestamp_ntz '2000-01-01 00:00:00' as ts"
    )
    upsert_table(changed.unionByName(new), name, "ts")
    return spark.table(name)


@query(
    "window_topk_deep",
    """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity, rank FROM (
        SELECT *, (rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey))::INTEGER AS rank FROM lineitem)
    WHERE rank <= 2000
    """,
)
def window_topk_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hot groups and a limit above the one that Spark applies before the shuffle; ties share a rank."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return top_per_group(lines, "l_returnflag", "l_quantity desc, l_orderkey", 2000)
