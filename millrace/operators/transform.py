"""Column mapping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import line_fields, quoted, sql_literal
from millrace.schema import field_names

# Fixed value: this output name is always text.
ROW_KEY = "row_key"

# The run date is written $etl_date, with or without a site prefix ($abc_etl_date).
_RUN_DATE = re.compile(r"\$(?:\w+_)?etl_date\b")


def bind_run_date(sql: str, run_date: str | None) -> str:
    """Put the run date, as a quoted literal, where the text asks for it."""
    if not _RUN_DATE.search(sql):
        return sql
    if run_date is None:
        raise ValueError("the text uses the run date, but the task has none")
    literal = sql_literal(run_date)
    return _RUN_DATE.sub(lambda _: literal, sql)


def mapped_column(
    entry: Mapping[str, str], run_date: str | None = None, strict: bool = True
) -> Column:
    """One mapping entry: SQL expression, optional type, alias.

    ``strict`` says that the session casts by the ANSI rules, under which a plain cast
    of a value that does not fit ends the job.
    """
    text = entry.get("column_expr", "").strip()
    if not text:
        raise ValueError(f"mapping entry without column_expr: {dict(entry)}")
    alias = entry.get("column_alias", "").strip() or text
    value = F.expr(bind_run_date(text, run_date))
    if alias.lower() == ROW_KEY:
        return value.cast("string").alias(alias)
    wanted = entry.get("column_type", "").strip()
    if wanted:
        value = value.try_cast(wanted) if strict else value.cast(wanted)
    return value.alias(alias)


def map_columns(
    df: DataFrame,
    mapping: Sequence[Mapping[str, str]] | None,
    run_date: str | None = None,
) -> DataFrame:
    """Project to the mapped columns; without a mapping the frame stays as it is.

    Text that does not fit ``column_type`` becomes NULL.
    """
    if not mapping:
        return df
    strict = df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    return df.select(*[mapped_column(entry, run_date, strict) for entry in mapping])


def strip_family(mapping: Sequence[Mapping[str, str]]) -> list[dict[str, str]]:
    """Mapping over a wide-row scan: ``family:qualifier`` reads the column ``qualifier``."""
    plain = []
    for entry in mapping:
        family, mark, qualifier = entry.get("column_expr", "").partition(":")
        plain.append({**entry, "column_expr": qualifier if mark else family})
    return plain


def identity_mapping(names: str | Sequence[str]) -> list[dict[str, str]]:
    """Every listed column mapped to itself."""
    return [
        {"column_expr": "`" + name.replace("`", "``") + "`", "column_alias": name}
        for name in field_names(names)
    ]


def select_fields(df: DataFrame, names: str | Sequence[str] | None) -> DataFrame:
    """Keep the listed columns; an empty list keeps all."""
    wanted = field_names(names)
    return df.select(*[quoted(name) for name in wanted]) if wanted else df


def rename_all(df: DataFrame, names: str | Sequence[str] | None) -> DataFrame:
    """Rename every column by position."""
    wanted = field_names(names)
    return df.toDF(*wanted) if wanted else df


def split_fields(
    df: DataFrame, column: str, sep: str, names: str | Sequence[str], trim: bool = False
) -> DataFrame:
    """The fields of a text column as named string columns."""
    return df.select(*line_fields(quoted(column), sep, field_names(names), trim))
