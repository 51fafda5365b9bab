"""ETL and data-quality operators for Spark DataFrames.

Every operator takes DataFrames (or a session and a task) and returns a lazy
DataFrame. Sinks, streams and the quality gate start Spark jobs, and running values
start one to see how large the groups are.
"""

from millrace.functions.dates import date_dim, with_date_columns
from millrace.operators.cells import range_sorted, scan_cells, to_cells
from millrace.operators.keyed import delete_then_append, upsert_by_key, with_surrogate_key
from millrace.operators.payload import payload_lines, payload_rows
from millrace.operators.quality import (
    InlineSpec,
    QualityError,
    inline_quality,
    quality_report,
    rule_quality,
)
from millrace.operators.rows import compact, redistribute, select_rows
from millrace.operators.rules import apply_rules
from millrace.operators.transform import map_columns
from millrace.plans.jobs import run_apply, run_etl, run_multi, run_quality, run_rules, run_sql
from millrace.plans.script import run_script
from millrace.schema import fields_to_schema, schema_frame
from millrace.session import build_session, private_session
from millrace.sinks import write_sink
from millrace.sources import read_source
from millrace.streaming.ingest import ingest_stream, parse_messages, stop_stream

__all__ = [
    "InlineSpec",
    "QualityError",
    "apply_rules",
    "build_session",
    "compact",
    "date_dim",
    "delete_then_append",
    "fields_to_schema",
    "ingest_stream",
    "inline_quality",
    "map_columns",
    "parse_messages",
    "payload_lines",
    "payload_rows",
    "private_session",
    "quality_report",
    "range_sorted",
    "read_source",
    "redistribute",
    "rule_quality",
    "run_apply",
    "run_etl",
    "run_multi",
    "run_quality",
    "run_rules",
    "run_script",
    "run_sql",
    "scan_cells",
    "schema_frame",
    "select_rows",
    "stop_stream",
    "to_cells",
    "upsert_by_key",
    "with_date_columns",
    "with_surrogate_key",
    "write_sink",
]
