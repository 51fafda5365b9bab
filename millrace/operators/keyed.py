"""Upsert, delete-before-load and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.rows import first_per_key
from millrace.schema import field_names
from millrace.session import written

# The fields an upsert falls back to.
DEFAULT_RECORD_KEY = "uuid"
DEFAULT_PRECOMBINE = "ts"


def upsert_fields(
    columns: Sequence[str], record_key: str | None, precombine: str | None
) -> tuple[str, str]:
    """The record key and precombine field, falling back to the default names."""
    chosen = []
    for given, fallback, what in (
        (record_key, DEFAULT_RECORD_KEY, "record key"),
        (precombine, DEFAULT_PRECOMBINE, "precombine field"),
    ):
        if not given and fallback not in columns:
            raise ValueError(f"an upsert needs a {what}, or a column named {fallback}")
        chosen.append(given or fallback)
    return chosen[0], chosen[1]


def upsert_by_key(
    current: DataFrame,
    incoming: DataFrame,
    record_key: str | None = None,
    precombine: str | Sequence[str] | None = None,
    current_is_keyed: bool = False,
) -> DataFrame:
    """One row per key: the one with the highest precombine value.

    On equal values the incoming row wins, and NULL is the lowest. ``precombine`` may
    list tie-breakers after the first field. With ``current_is_keyed`` the caller states
    that ``current`` has each key once; it is then not ranked but joined, and when Spark
    sees that the incoming rows are small it broadcasts them and ``current`` does not
    move at all.
    """
    listed = field_names(precombine)
    key_text, first = upsert_fields(current.columns, record_key, listed[0] if listed else None)
    keys, fields = field_names(key_text), [first, *listed[1:]]
    if current_is_keyed:
        return _merge(current, incoming, keys, fields)
    mark = "__incoming"
    best = [quoted(name).desc_nulls_last() for name in fields]
    both = current.withColumn(mark, F.lit(0)).unionByName(incoming.withColumn(mark, F.lit(1)))
    return first_per_key(both, keys, [*best, F.col(mark).desc()]).drop(mark)


def _merge(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Rows of ``current``, replaced where the best incoming one is not older, and new keys.

    The key is a struct, in which a NULL equals a NULL. The best incoming rows are written
    once; of ``current`` the keys alone are read a second time, to tell which are new.
    """
    key, row = "__key", "__row"
    columns = current.columns
    _refuse(columns, (key, row))
    latest = first_per_key(incoming, keys, [quoted(name).desc_nulls_last() for name in fields])
    old = current.withColumn(key, F.struct(*[quoted(name) for name in keys]))
    new = latest.select(
        F.struct(*[quoted(name) for name in keys]).alias(key),
        F.struct(*[quoted(name) for name in columns]).alias(row),
    )
    new = written(new, "incoming")
    kept = old.join(new, key, "left").select(*_newer(columns, fields, row))
    known = old.select(key).join(new.select(key), key, "left_semi")
    fresh = new.join(known, key, "left_anti").select(
        *[F.col(row)[name].alias(name) for name in columns]
    )
    return kept.unionByName(fresh)


def _newer(columns: Sequence[str], fields: Sequence[str], row: str) -> list[Column]:
    """The columns of the row beside the current one where that is there and not older."""
    newest = F.struct(*[F.col(row)[name] for name in fields])
    replaced = F.col(row).isNotNull() & (newest >= F.struct(*[quoted(name) for name in fields]))
    return [F.when(replaced, F.col(row)[name]).otherwise(quoted(name)).alias(name) for name in columns]


def _refuse(columns: Sequence[str], reserved: Sequence[str]) -> None:
    taken = [name for name in columns if name.lower() in reserved]
    if taken:
        raise ValueError(f"columns {taken} are reserved for an upsert")


def merge_in_place(
    current: DataFrame,
    incoming: DataFrame,
    record_key: str | Sequence[str],
    precombine: str | Sequence[str],
    buckets: int,
) -> DataFrame:
    """Upsert into a table that is bucketed by its key, each input read once.

    One full outer join: the incoming rows are dealt to the table's ``buckets``, ranked there
    and met by the buckets as they lie, so ``current`` is not moved. Which row wins is as in
    ``upsert_by_key``. ``current`` has each key once and none that is NULL; a NULL key
    among the incoming rows ends the job.
    """
    keys, fields = field_names(record_key), field_names(precombine)
    columns, row, mark = current.columns, "__row", "__current"
    _refuse(columns, (row, mark, *(f"__key_{i}" for i in range(len(keys)))))
    dealt = require_key(incoming.select(*[quoted(name) for name in columns]), keys)
    dealt = dealt.repartition(buckets, *[quoted(name) for name in keys])
    latest = first_per_key(dealt, keys, [quoted(name).desc_nulls_last() for name in fields])
    new = latest.select(
        *[quoted(name).alias(f"__key_{i}") for i, name in enumerate(keys)],
        F.struct(*[quoted(name) for name in columns]).alias(row),
    )
    same = [quoted(name) == F.col(f"__key_{i}") for i, name in enumerate(keys)]
    joined = current.withColumn(mark, F.lit(True)).join(new, same, "full_outer")
    chosen = F.when(F.col(mark).isNull(), F.col(row)).otherwise(
        F.struct(*_newer(columns, fields, row))
    )
    return joined.select(chosen.alias(row)).select(f"{row}.*")


def delete_then_append(
    current: DataFrame, predicate: str | Column | None, incoming: DataFrame
) -> DataFrame:
    """Drop the rows the predicate holds for, then add the new ones."""
    if predicate is not None and not (isinstance(predicate, str) and not predicate.strip()):
        doomed = F.expr(predicate) if isinstance(predicate, str) else predicate
        current = current.filter(~F.coalesce(doomed, F.lit(False)))
    return current.unionByName(incoming)


def with_surrogate_key(df: DataFrame, name: str = "auto_md5") -> DataFrame:
    """Add a digest that is distinct for every row.

    The row's position in its partition goes into the digest beside the random number
    and the clock: a random double alone would repeat among some 10^8 rows.
    """
    seed = F.concat_ws("-", F.rand(), F.monotonically_increasing_id(), F.current_timestamp())
    return df.withColumn(name, F.md5(seed))


def require_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The key columns must hold values; a NULL there ends the job."""
    wanted = set(field_names(keys))
    return df.select(
        *[_non_null(name) if name in wanted else quoted(name) for name in df.columns]
    )


def _non_null(name: str) -> Column:
    message = F.lit(f"key column {name} is NULL")
    return F.coalesce(quoted(name), F.raise_error(message)).alias(name)
