"""Rows a mapping cannot take, kept with their reasons beside those it can."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.transform import bind_run_date, mapped_column
from millrace.session import written

REASONS = "reject_reasons"
SOURCE_ROW = "rejected_row"
_SPLIT = "__rejected"


def cast_reasons(mapping: Sequence[Mapping[str, str]], run_date: str | None = None) -> list[Column]:
    """Per typed entry a text that says which value does not fit, or NULL if all is well."""
    reasons = []
    for entry in mapping:
        kind, text = entry.get("column_type", "").strip(), entry.get("column_expr", "").strip()
        if kind and text:
            value = F.expr(bind_run_date(text, run_date))
            alias = entry.get("column_alias", "").strip() or text
            told = F.concat(F.lit(f"{alias}: "), value.cast("string"), F.lit(f" is no {kind}"))
            reasons.append(F.when(value.isNotNull() & value.try_cast(kind).isNull(), told))
    return reasons


def tag_rejects(
    df: DataFrame,
    mapping: Sequence[Mapping[str, str]],
    run_date: str | None = None,
    more: Sequence[Column] = (),
    row: Column | None = None,
) -> DataFrame:
    """The mapped columns, and beside them the reasons against a row and the row it came from.

    A value that is there but does not fit its type is a reason, a NULL is none. ``more`` are
    reasons of the caller, NULL where there is none; ``row`` is the text to keep of a
    rejected row, else all its columns as JSON. Both are empty where a row is accepted.
    """
    taken = {REASONS, SOURCE_ROW, _SPLIT} & {str(entry.get("column_alias", "")).strip() for entry in mapping}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are reserved for rejects")
    found = F.filter(F.array(F.lit(None).cast("string"), *more, *cast_reasons(mapping, run_date)), lambda r: r.isNotNull())
    whole = row if row is not None else F.to_json(F.struct(*[quoted(name) for name in df.columns]))
    return df.select(
        *[mapped_column(entry, run_date) for entry in mapping],
        found.alias(REASONS),
        F.when(F.size(found) > 0, whole).alias(SOURCE_ROW),
    )


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and ``(reject_reasons, rejected_row)`` of the others.

    The tagged rows are evaluated once: they are written to shared scratch in two parts,
    and each result reads its own.
    """
    held = written(tagged.withColumn(_SPLIT, F.size(REASONS) > 0), "rejects", partition_by=[_SPLIT])
    accepted = held.where(~F.col(_SPLIT)).drop(_SPLIT, REASONS, SOURCE_ROW)
    return accepted, held.where(F.col(_SPLIT)).select(REASONS, SOURCE_ROW)
