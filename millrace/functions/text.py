"""Separators taken literally, fields of a line, whole-string matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its exact name, dots and colons included."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_literal(value: str) -> str:
    """A value as a quoted SQL string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def real_separator(sep: str) -> str:
    """Task files spell a tab as a backslash and a t."""
    return "\t" if sep == "\\t" else sep


def literal_pattern(sep: str) -> str:
    """A regular expression that matches ``sep`` and nothing else."""
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_literal(value: Column, sep: str) -> Column:
    """Split on a literal separator, without the empty fields at the end of the line; at least one field."""
    pattern = literal_pattern(real_separator(sep))
    return F.split(F.regexp_replace(value, f"(?:{pattern})+$", ""), pattern)


def line_fields(value: Column, sep: str, names: Sequence[str], trim: bool = False) -> list[Column]:
    """The fields of a line by position; a short line gives NULLs.

    All fields read the same split, outside any branch, so that Spark evaluates it once a row.
    """
    parts = split_literal(value, sep)
    fields = [F.get(parts, F.lit(i)) for i in range(len(names))]
    # A line of separators alone has no field; an empty line has one.
    fields[:1] = [F.when((F.size(parts) > 1) | (field != "") | (value == ""), field) for field in fields[:1]]
    if trim:
        fields = [F.trim(field) for field in fields]
    return [field.alias(name) for field, name in zip(fields, names)]


def full_match(value: Column, pattern: str) -> Column:
    """True when the whole string matches, as ``String.matches`` does."""
    return value.rlike(f"^(?:{pattern})\\z")
