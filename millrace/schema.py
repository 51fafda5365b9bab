"""Schemas from field lists, and schemas as frames."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def field_names(fields: str | Sequence[str] | None) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` as a list; nothing, or blank text, is an empty list."""
    if fields is None:
        return []
    items = fields.split(",") if isinstance(fields, str) else fields
    return [item.strip() for item in items if item and item.strip()]


def text_schema(fields: str | Sequence[str]) -> T.StructType:
    """One nullable string column per listed name, in order."""
    return T.StructType([T.StructField(name, T.StringType()) for name in field_names(fields)])


def fields_to_schema(fields: str | Sequence[str]) -> T.StructType:
    """Dotted paths as a nested struct of strings.

    ``"name,job.title,job.pay"`` is ``struct<name,job:struct<title,pay>>``. Shared
    prefixes merge and a repeated path counts once. ``path as alias`` is accepted;
    the alias has no effect.
    """
    tree: dict = {}
    names = field_names(fields)
    if not names:
        raise ValueError("the field list is empty")
    for item in names:
        words = item.split()
        aliased = len(words) == 3 and words[1] == "as"
        if not (len(words) == 1 or aliased) or not re.fullmatch(r"\w+(\.\w+)*", words[0]):
            raise ValueError(f"cannot read field {item!r}; expected parent.child [as alias]")
        node = tree
        for part in words[0].split("."):
            node = node.setdefault(part, {})
    return _struct(tree)


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _struct(sub) if sub else T.StringType()) for name, sub in tree.items()]
    )


def schema_frame(df: DataFrame) -> DataFrame:
    """The columns of a frame as rows ``(position, col_name, data_type, nullable)``."""
    rows = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, col_name string, data_type string, nullable boolean"
    )
