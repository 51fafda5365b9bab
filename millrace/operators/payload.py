"""Tables out of a column of fetched documents."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import line_fields, quoted
from millrace.schema import field_names, fields_to_schema


def payload_rows(
    df: DataFrame,
    column: str,
    schema: str | T.StructType,
    path: str = "",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of a JSON document: follow the dotted path, then read an array or one object.

    ``schema`` is a struct, or a list of dotted fields. A document without the path, or
    with something else there, gives no row. ``keep`` names columns carried along.
    """
    if isinstance(schema, str):
        schema = fields_to_schema(schema)
    text = quoted(column)
    if path.strip():
        steps = path.strip().split(".")
        if not all(re.fullmatch(r"\w+", step) for step in steps):
            raise ValueError(f"cannot follow path {path!r}")
        text = F.get_json_object(text, "$." + ".".join(steps))
    items = F.from_json(text, T.ArrayType(schema))
    return df.select(*[quoted(name) for name in keep], F.inline(items))


def payload_lines(
    df: DataFrame,
    column: str,
    names: str | Sequence[str],
    sep: str = ",",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of a delimited document: one per line, fields by position."""
    kept = [quoted(name) for name in keep]
    lines = df.select(*kept, F.explode(F.split(quoted(column), "\n")).alias("__line"))
    return lines.select(*kept, *line_fields(F.col("__line"), sep, field_names(names)))
