"""Tasks: one dictionary in, sources read, frames built, one sink written.

A task is the message task authors already write: ``dsi_Input`` and ``dsi_Output``
describe the stores, ``tli`` the run, and one block the task itself. A store's base
keys and the extra keys of the task are merged, the extra ones last.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.quality import InlineSpec, WatchedRows, gate, quality_report, rule_quality
from millrace.operators.rejects import split_rejects, tag_rejects
from millrace.operators.rows import redistribute, select_rows
from millrace.operators.rules import apply_rules
from millrace.operators.transform import identity_mapping, map_columns, strip_family
from millrace.plans.script import drop_views, run_script, view_names, view_of
from millrace.schema import field_names
from millrace.session import job_group, private_session, written
from millrace.sinks import write_sink
from millrace.sources import source_frame
from millrace.sources.registry import STREAM_TYPES
from millrace.streaming.ingest import ingest_stream

# Keys of a task, and what a writer assumes where a task is silent.
ETL_BLOCK = "etlTaskInfo"
APPLY_BLOCK = "etlApplyTaskInfo"
MULTI_BLOCK = "etlMoreTaskInfo"
SQL_BLOCK = "sqlTaskInfo"
RULES_BLOCK = "etlDroolsTaskInfo"
QUALITY_BLOCK = "qualityTaskInfo"
INPUT_KEYS = {
    "fileType": ("file_type_input", "csv"),
    "encoding": ("encoding_input", "utf-8"),
    "sep": ("sep_input", ","),
    "header": ("header_input", "false"),
}
OUTPUT_KEYS = {
    "fileType": ("file_type_output", "csv"),
    "encoding": ("encoding_output", "utf-8"),
    "sep": ("sep_output", ","),
    "header": ("header_output", "false"),
    "merge": ("merge_output", "-1"),
    "model": ("model_output", "append"),
    "partition_by": ("partition_by_output", ""),
}


# UDFs by the name SQL text calls them by.
Functions = Mapping[str, object]


@dataclass
class TaskResult:
    """What a task built: the frame (lazy), its reports, and what the sink returned.

    A task over a stream has the running query instead of a frame.
    """

    frame: DataFrame | None
    session: SparkSession
    quality: dict | None = None
    written: object = None
    views: list[str] = field(default_factory=list)
    stream: StreamingQuery | None = None


def _json(text: object) -> dict:
    if isinstance(text, Mapping):
        return dict(text)
    text = str(text or "").strip()
    return json.loads(text) if text else {}


def run_date(task: Mapping) -> str | None:
    """``ETL_DATE`` of the run's parameters."""
    value = _json(task.get("tli", {}).get("params")).get("ETL_DATE")
    return None if value is None else str(value)


def input_options(store: Mapping, info: Mapping) -> dict[str, object]:
    options = {**store, **_json(info.get("data_sources_params_input"))}
    for key, (name, default) in INPUT_KEYS.items():
        options[key] = info.get(name, default)
    return options


def output_options(store: Mapping, info: Mapping) -> dict[str, object]:
    options = {**store, **_json(info.get("data_sources_params_output"))}
    for key, (name, default) in OUTPUT_KEYS.items():
        options[key] = info.get(name, default)
    return options


def input_fields(info: Mapping) -> list[str]:
    """File columns, or else table columns."""
    return field_names(info.get("data_sources_file_columns")) or field_names(
        info.get("data_sources_table_columns")
    )


def _group(task: Mapping, info: Mapping) -> tuple[str, str]:
    run = task.get("tli", {})
    log_id = str(task.get("task_logs_id", "001"))
    name = info.get("etl_context") or info.get("sql_context") or info.get("quality_context")
    group = f"{log_id}_{run.get('job_context', '001')}"
    return group, f"{name or info.get('id', '')}_{run_date(task) or ''}_{log_id}"


def read_mapped(
    spark: SparkSession,
    store: Mapping,
    info: Mapping,
    mapping: Sequence[Mapping[str, str]] | None,
    date: str | None,
    keep_report: Callable[[DataFrame], None] | None = None,
    keep_rejects: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, dict | None]:
    """Read, filter, drop duplicates, run the quality gate, map, repartition.

    ``keep_report`` gets the quality report, whether or not the gate lets the load go on.
    ``keep_rejects`` gets the rows with a value that does not fit its type, which then are
    not loaded; without it such a value becomes NULL.
    """
    kind = str(store.get("data_source_type", "")).lower()
    df = source_frame(
        spark,
        kind,
        input_options(store, info),
        input_fields(info),
        str(info.get("data_sources_filter_input") or ""),
    )
    df = select_rows(df, None, info.get("duplicate_columns"), info.get("duplicate_order_by"))
    report = None
    if str(info.get("enable_quality", "off")).strip() == "on":
        # Checked as it is written, and loaded from what was: the source is read once, and
        # of duplicates the same stay for both.
        watched = WatchedRows(df, InlineSpec.from_task(info, mapping))
        df = written(watched.frame, "gated")
        checks = watched.report(df)
        report = checks.first().asDict()
        if keep_report:
            keep_report(spark.createDataFrame([report], checks.schema))
        gate(report)
    if kind == "hbase" and mapping:
        mapping = strip_family(mapping)
    if keep_rejects and mapping:
        df, rejected = split_rejects(tag_rejects(df, mapping, date))
        keep_rejects(rejected)
    else:
        df = map_columns(df, mapping, date)
    return (
        redistribute(df, info.get("repartition_num_input"), info.get("repartition_cols_input")),
        report,
    )


def _sink(task: Mapping, info: Mapping) -> dict[str, object]:
    store = task.get("dsi_Output") or {}
    return {
        "type": str(store.get("data_source_type") or "").strip(),
        "options": output_options(store, info),
        "clear": info.get("data_sources_clear_output"),
    }


def _write(task: Mapping, info: Mapping, df: DataFrame) -> object:
    sink = _sink(task, info)
    return write_sink(df, sink) if sink["type"] else None


def report_keeper(
    task: Mapping, info: Mapping, source: Mapping | None = None, kind: str = "dsi_Report"
) -> Callable[[DataFrame], None] | None:
    """Append reports, with the run they belong to, to the store of ``dsi_Report``.

    With ``kind`` ``dsi_Reject`` it is rejected rows, to the store of that name.
    """
    store = task.get(kind) or {}
    if not store.get("data_source_type"):
        return None
    run, block = task.get("tli", {}), source or info
    labels = {
        "task_logs_id": task.get("task_logs_id", "001"),
        "job_id": run.get("job_id", "001"),
        "job_context": run.get("job_context", "001"),
        "etl_task_id": block.get("id", "001"),
        "etl_context": block.get("etl_context") or block.get("quality_context") or "",
        "etl_date": run_date(task) or "",
        "owner": run.get("owner", "001"),
    }

    def keep(report: DataFrame) -> None:
        tagged = report.select(*[F.lit(str(v)).alias(k) for k, v in labels.items()], "*")
        options = {"fileType": "parquet", **store, "model": "append"}
        write_sink(tagged, {"type": store["data_source_type"], "options": options})

    return keep


def _session(
    spark: SparkSession, task: Mapping, info: Mapping, functions: Functions | None
) -> SparkSession:
    """The session of a task: its options, its views, and the functions it may call."""
    store = task.get("dsi_Input") or {}
    own = private_session(spark, {**store, **_json(info.get("data_sources_params_input"))})
    for name, function in (functions or {}).items():
        own.udf.register(name, function)
    return own


def run_etl(
    spark: SparkSession,
    task: Mapping,
    functions: Functions | None = None,
    block: str = ETL_BLOCK,
) -> TaskResult:
    """One source, one mapping, one sink.

    ``functions`` are UDFs the SQL text of the task may call by name. From a stream the
    task goes on until ``stop_stream`` is called with its ``job_id``.
    """
    info = task.get(block, {})
    own = _session(spark, task, info, functions)
    if str(task.get("dsi_Input", {}).get("data_source_type", "")).lower() in STREAM_TYPES:
        return _start_stream(own, task, info)
    with job_group(spark, *_group(task, info)):
        df, report = read_mapped(
            own,
            task.get("dsi_Input", {}),
            info,
            info.get("column_data_list"),
            run_date(task),
            report_keeper(task, info),
            report_keeper(task, info, kind="dsi_Reject"),
        )
        return TaskResult(df, own, report, _write(task, info, df))


def _start_stream(own: SparkSession, task: Mapping, info: Mapping) -> TaskResult:
    options = input_options(task["dsi_Input"], info)
    stream = {
        "type": task["dsi_Input"]["data_source_type"],
        "options": options,
        "fields": input_fields(info),
        "mapping": info.get("column_data_list"),
        "where": str(info.get("data_sources_filter_input") or ""),
        "name": str(task.get("tli", {}).get("job_id", "001")),
        "once": str(options.get("once", "false")).lower() == "true",
        "run_date": run_date(task),
    }
    if (task.get("dsi_Reject") or {}).get("data_source_type"):
        store = task["dsi_Reject"]
        kept = {"fileType": "parquet", "model": "append", **store}
        stream["rejects"] = {"type": store["data_source_type"], "options": kept}
    return TaskResult(None, own, stream=ingest_stream(own, stream, _sink(task, info)))


def run_apply(
    spark: SparkSession, task: Mapping, functions: Functions | None = None
) -> TaskResult:
    """The same as ``run_etl``, under its own task block."""
    return run_etl(spark, task, functions, APPLY_BLOCK)


def _read_views(
    spark: SparkSession, task: Mapping, script: str, hashed: bool
) -> dict[str, DataFrame]:
    named = {} if hashed else view_names(script)
    views = {}
    for source in task.get("dsi_EtlInfo", []):
        store, info = source.get("dsi_Input", {}), source.get(ETL_BLOCK, {})
        kind = str(store.get("data_source_type", "")).lower()
        if kind in STREAM_TYPES:
            raise ValueError(f"a source of type {kind} is a stream; scripts run on tables")
        view = view_of(str(info.get("etl_context", "")), named, hashed)
        views[view], _ = read_mapped(
            spark,
            store,
            info,
            info.get("column_data_list"),
            run_date(task),
            report_keeper(task, info),
            report_keeper(task, info, kind="dsi_Reject"),
        )
    return views


def _drop_list(info: Mapping, views: Mapping[str, DataFrame]) -> list[str]:
    return [*views, *field_names(info.get("drop_tmp_tables"))]


def run_multi(
    spark: SparkSession, task: Mapping, functions: Functions | None = None
) -> TaskResult:
    """Several sources as views, one script over them, one sink."""
    info = task.get(MULTI_BLOCK, {})
    script = str(info.get("etl_sql", ""))
    own = _session(spark, task, info, functions)
    with job_group(spark, *_group(task, info)):
        views = _read_views(own, task, script, hashed=False)
        try:
            df = run_script(own, script, views, run_date(task))
            return TaskResult(df, own, None, _write(task, info, df), list(views))
        finally:
            drop_views(own, _drop_list(info, views))


def run_sql(
    spark: SparkSession, task: Mapping, functions: Functions | None = None
) -> TaskResult:
    """A script over what the catalog has; without a sink it only runs."""
    info = task.get(SQL_BLOCK, {})
    own = _session(spark, task, info, functions)
    with job_group(spark, *_group(task, info)):
        df = run_script(own, str(info.get("etl_sql", "")), None, run_date(task))
        return TaskResult(df, own, None, _write(task, info, df))


def run_rules(
    spark: SparkSession, task: Mapping, functions: Functions | None = None
) -> TaskResult:
    """Rules over the result of another task, a filter on what they give, one sink."""
    info = task.get(RULES_BLOCK, {})
    date = run_date(task)
    kind = str(info.get("more_task", "")).upper()
    own = _session(spark, task, info, functions)
    views: dict[str, DataFrame] = {}
    with job_group(spark, *_group(task, info)):
        if kind == "ETL":
            source = (task.get("dsi_EtlInfo") or [{}])[0]
            store, source_info = source.get("dsi_Input", {}), source.get(ETL_BLOCK, {})
            if str(store.get("data_source_type", "")).lower() in STREAM_TYPES:
                raise ValueError("rules run on tables, not on streams")
            df, _ = read_mapped(
                own,
                store,
                source_info,
                source_info.get("column_data_list"),
                date,
                report_keeper(task, info, source_info),
            )
        elif kind == "MORE_ETL":
            multi = task.get(MULTI_BLOCK, {})
            script = str(multi.get("etl_sql", ""))
            views = _read_views(own, task, script, hashed=True)
            df = run_script(own, script, views, date)
            drop_views(own, _drop_list(multi, views))
        elif kind == "SQL":
            df = run_script(own, str(task.get(SQL_BLOCK, {}).get("etl_sql", "")), None, date)
        else:
            raise ValueError(f"more_task {kind!r} is not one of ETL, MORE_ETL, SQL")
        df = apply_rules(df, info.get("etl_drools", ""), date)
        df = select_rows(df, str(info.get("data_sources_filter_input") or ""))
        return TaskResult(df, own, None, _write(task, info, df), list(views))


def run_quality(
    spark: SparkSession, task: Mapping, functions: Functions | None = None
) -> TaskResult:
    """Rules of a quality task over its source; the frame is the report."""
    info = task.get(QUALITY_BLOCK, {})
    own = _session(spark, task, info, functions)
    with job_group(spark, *_group(task, info)):
        fields = field_names(info.get("data_sources_file_columns"))
        df, _ = read_mapped(
            own, task.get("dsi_Input", {}), info, identity_mapping(fields), run_date(task)
        )
        rules = info.get("quality_rule_config") or []
        rules = json.loads(rules) if isinstance(rules, str) else rules
        report = quality_report(rule_quality(df, rules))
        # One row per rule of the task: computed once, whoever asks for it.
        report = own.createDataFrame(report.collect(), report.schema)
        keep_report = report_keeper(task, info)
        if keep_report:
            keep_report(report)
        return TaskResult(report, own, None, _write(task, info, report))
