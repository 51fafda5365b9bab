"""JDBC options, reads, writes and the statement that clears a target.

Spark's own JDBC source does the partitioned scan, pushes filters down and prunes
columns; what is added here is the mapping of task keys to its options.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.modes import save_mode
from millrace.operators.rows import compact, select_rows
from millrace.schema import field_names
from millrace.sources.files import TASK_KEYS

log = logging.getLogger(__name__)

# Keys of a task that Spark's JDBC source does not know. It has url, user and password.
_NOT_JDBC = (TASK_KEYS - {"url", "user", "password"}) | {
    "filter.optimize",
    "sep",
    "encoding",
    "header",
}
# What drivers say when the table to clear is not there.
_MISSING_TABLE = ("doesn't exist", "does not exist", "unknown table")


def jdbc_options(options: Mapping[str, object], write: bool = False) -> dict[str, str]:
    """Task keys as options of Spark's JDBC source."""
    wanted = ["url", "dbtable"] if write or "query" not in options else ["url", "query"]
    if not write:
        wanted.append("driver")
        if options.get("dbtable") and options.get("query"):
            raise ValueError("a JDBC source takes either dbtable or query")
    for key in wanted:
        if not str(options.get(key) or "").strip():
            raise ValueError(f"a JDBC store needs {key!r}")
    return {
        key: str(value)
        for key, value in options.items()
        if key not in _NOT_JDBC and not key.startswith("spark.") and value not in (None, "")
    }


def jdbc_read_options(
    options: Mapping[str, object],
    fields: str | Sequence[str] | None = None,
    where: str | None = None,
) -> tuple[dict[str, str], str | None]:
    """Reader options, and the filter that is left for Spark.

    With ``filter.optimize`` the filter runs in the database, in its own dialect, as a
    subquery that also selects the fields.
    """
    chosen = jdbc_options(options)
    optimize = str(options.get("filter.optimize", "false")).lower() == "true"
    if not (optimize and where and where.strip() and "dbtable" in chosen):
        return chosen, where
    columns = ",".join(field_names(fields)) or "*"
    chosen["dbtable"] = f"(select {columns} from {chosen['dbtable']} where {where}) filter_tmp"
    return chosen, None


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, object],
    fields: str | Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    chosen, rest = jdbc_read_options(options, fields, where)
    return select_rows(spark.read.format("jdbc").options(**chosen).load(), rest)


def write_jdbc(
    df: DataFrame, options: Mapping[str, object], clear: str | None = None
) -> None:
    """Clear with one statement if asked, then write.

    The mode is append unless ``model`` says otherwise; with ``truncate`` an overwrite
    keeps the table definition.
    """
    if clear and clear.strip():
        clear_target(df.sparkSession, options, clear)
    chosen = jdbc_options(options, write=True)
    df = compact(df, options.get("merge", -1))
    df.write.format("jdbc").mode(save_mode(options.get("model"))).options(**chosen).save()


def clear_target(spark: SparkSession, options: Mapping[str, object], statement: str) -> None:
    """Run one statement at the target. A missing table is no error."""
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    for key in ("user", "password"):
        if options.get(key):
            properties.setProperty(key, str(options[key]))
    if options.get("driver"):
        jvm.java.lang.Class.forName(str(options["driver"]))
    connection = jvm.java.sql.DriverManager.getConnection(str(options["url"]), properties)
    try:
        run = connection.prepareStatement(statement)
        try:
            run.execute()
        finally:
            run.close()
    except Exception as error:
        if not any(text in str(error).lower() for text in _MISSING_TABLE):
            raise
        log.warning("nothing to clear: %s", error)
    finally:
        connection.close()
