"""SQL scripts: statements in order, views by name, the last one is the result."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.transform import bind_run_date
from millrace.session import written

# How a script names the view of a source, and how statements end.
VIEW_MARK = "--table"
_STATEMENT_END = re.compile(r";\r?\n")

# What is not SQL names: strings and comments.
_NOT_NAMES = re.compile(r"'(?:\\.|''|[^'\\])*'|\"(?:\\.|[^\"\\])*\"|--[^\n]*|/\*.*?\*/", re.S)
_MADE_VIEW = re.compile(
    r"^\s*create\s+(?:or\s+replace\s+)?temp(?:orary)?\s+view\s+(?:if\s+not\s+exists\s+)?"
    r"(?:`(?P<quoted>[^`]+)`|(?P<plain>\w+))(?:\s*\([^)]*\))?(?:\s+comment\s+\S+)?\s+as\b",
    re.I,
)


def statements(script: str) -> list[str]:
    """The statements of a script, without the lines that name views."""
    found = []
    for part in _STATEMENT_END.split(script.strip()):
        lines = [line for line in part.splitlines() if not line.strip().startswith(VIEW_MARK)]
        text = "\n".join(lines).strip().rstrip(";").strip()
        if text:
            found.append(text)
    return found


def view_names(script: str) -> dict[str, str]:
    """``--table <source name>=<view>`` lines as a map from source name to view."""
    views = {}
    for line in script.splitlines():
        line = line.strip().rstrip(";").strip()
        if line.startswith(VIEW_MARK):
            source, mark, view = line[len(VIEW_MARK) :].partition("=")
            if not mark or not view.strip():
                raise ValueError(f"cannot read {line!r}; expected {VIEW_MARK} source=view")
            views[source.strip()] = view.strip()
    return views


def view_of(source: str, named: Mapping[str, str], hashed: bool = False) -> str:
    """The view of a source: from its ``--table`` line, or ``source#view`` when hashed."""
    if hashed:
        _, mark, view = source.partition("#")
        if not mark or not view.strip():
            raise ValueError(f"source {source!r} needs the form name#view")
        return view.strip()
    if source not in named:
        raise ValueError(f"the script needs a line {VIEW_MARK} {source}=<view>")
    return named[source]


def references(text: str, name: str) -> int:
    """How often a statement names a table or view; strings and comments do not count."""
    return len(re.findall(rf"(?<![\w.`])`?{re.escape(name)}`?(?![\w`(])", _NOT_NAMES.sub(" ", text), re.I))


def run_script(
    spark: SparkSession,
    script: str,
    views: Mapping[str, DataFrame] | None = None,
    run_date: str | None = None,
) -> DataFrame:
    """Run the statements in this session and return the frame of the last.

    A view that the statements name more than once, whether it is handed in or made by
    ``create temporary view ... as``, is written once to shared scratch and read from there,
    so its source is scanned once and every use sees the same rows.
    """
    found = statements(bind_run_date(script, run_date))
    if not found:
        raise ValueError("the script has no statement")
    for name, frame in (views or {}).items():
        if frame.isStreaming:
            raise ValueError(f"view {name} is a stream; scripts run on tables")
        if sum(references(text, name) for text in found) > 1:
            frame = written(frame, "view")
        frame.createOrReplaceTempView(name)
    result = None
    for place, text in enumerate(found):
        result = spark.sql(text)
        made = _MADE_VIEW.match(text)
        name = made and (made["quoted"] or made["plain"])
        if name and sum(references(later, name) for later in found[place + 1 :]) > 1:
            written(spark.table(name), "view").createOrReplaceTempView(name)
    return result


def drop_views(spark: SparkSession, names) -> None:
    for name in names:
        spark.catalog.dropTempView(name)
