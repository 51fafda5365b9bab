"""Quality checks: inline checks of a load, and rule lists of their own.

All checks that look at one row at a time share one aggregate. A key check groups by
the key columns themselves, so NULL is a key value and no two keys run together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.text import full_match, quoted
from millrace.schema import field_names

PASS = "pass"
FAIL = "fail"
WITHIN_TOLERANCE = "within_tolerance"
NOT_CHECKED = "not_checked"

# Rule types, the one built-in rule, and the default tolerance.
RULE_SQL = "1"
RULE_REGEX = "2"
RULE_BUILT_IN = "3"
PRIMARY_KEY_CHECK = "primary_key_check"
DEFAULT_ERROR_RATE = 0.01


class QualityError(Exception):
    """The gate of a load did not pass."""


@dataclass(frozen=True)
class InlineSpec:
    """What the inline checks ask of a frame."""

    primary_columns: Sequence[str] = ()
    column_size: int = 0
    rows_range: str = ""
    not_null: Sequence[str] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)
    patterns: Sequence[tuple[str, str]] = ()
    error_rate: float = DEFAULT_ERROR_RATE

    @classmethod
    def from_task(cls, info: Mapping, mapping: Sequence[Mapping[str, str]] | None) -> InlineSpec:
        """Read the checks out of a task and its column mapping."""
        not_null: list[str] = []
        lengths: dict[str, int] = {}
        patterns: list[tuple[str, str]] = []
        for entry in mapping or []:
            name = str(entry.get("column_name", "")).strip()
            pattern = str(entry.get("column_regex", "")).strip()
            length = str(entry.get("column_length", "")).strip()
            nullable = str(entry.get("column_is_null", "true")).strip() != "false"
            if not name and (pattern or length or not nullable):
                raise ValueError(f"a column check needs column_name: {dict(entry)}")
            if not nullable:
                not_null.append(name)
            if pattern:
                patterns.append((name, pattern))
            if length:
                lengths[name] = int(length)
        return cls(
            primary_columns=field_names(info.get("primary_columns")),
            column_size=int(info.get("column_size") or 0),
            rows_range=str(info.get("rows_range") or "").strip(),
            not_null=not_null,
            lengths=lengths,
            patterns=patterns,
            error_rate=float(info.get("error_rate") or DEFAULT_ERROR_RATE),
        )

    def row_bounds(self) -> tuple[int, int] | None:
        if not self.rows_range:
            return None
        low, mark, high = self.rows_range.partition("-")
        return int(low), int(high if mark else low)


def _any(conditions: Sequence[Column]) -> Column:
    flag = F.lit(False)
    for condition in conditions:
        flag = flag | F.coalesce(condition, F.lit(False))
    return flag


def _flags(spec: InlineSpec) -> dict[str, Column]:
    """Row-level failures. A NULL length does not fail; a NULL never matches a pattern."""
    return {
        "null_rows": _any([quoted(name).isNull() for name in spec.not_null]),
        "length_rows": _any([F.length(quoted(name)) != n for name, n in spec.lengths.items()]),
        "regex_rows": _any(
            [
                ~F.coalesce(full_match(quoted(name), pattern), F.lit(False))
                for name, pattern in spec.patterns
            ]
        ),
    }


def _row_counts(spec: InlineSpec) -> list[Column]:
    ones = F.count(F.lit(1)).alias("total_rows")
    return [ones, *[F.count_if(flag).alias(name) for name, flag in _flags(spec).items()]]


def inline_metrics(df: DataFrame, spec: InlineSpec) -> DataFrame:
    """One row of counts. With a key it still reads the input once.

    The flags are summed per key on the way, so the shuffle carries one row per key
    and map task, whatever a key's share of the data.
    """
    counts = _row_counts(spec)
    if not spec.primary_columns:
        return df.agg(*counts, F.lit(0).cast("bigint").alias("duplicate_keys"))
    keys = [quoted(name).alias(f"__k_{i}") for i, name in enumerate(spec.primary_columns)]
    per_key = df.groupBy(*keys).agg(*counts)
    sums = [
        F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("total_rows", *_flags(spec))
    ]
    return per_key.agg(*sums, F.count_if(F.col("total_rows") > 1).alias("duplicate_keys"))


class WatchedRows:
    """A frame whose row checks are counted by the action that writes it.

    ``frame`` is to be written once, by an action of its own: the counts are made in the
    tasks that write, where Spark counts a partition once however often its task is run.
    """

    def __init__(self, df: DataFrame, spec: InlineSpec):
        self._spec, self._seen = spec, Observation()
        self.frame = df.observe(self._seen, *_row_counts(spec))

    def report(self, copy: DataFrame) -> DataFrame:
        """The inline report, once ``frame`` has been written and ``copy`` reads what was.

        Only a key check reads the copy, and of it the key columns alone.
        """
        spark, keys = copy.sparkSession, self._spec.primary_columns
        kinds = ", ".join(f"{name} bigint" for name in self._seen.get)
        seen = spark.createDataFrame([tuple(self._seen.get.values())], kinds)
        if keys:
            groups = copy.groupBy(*[quoted(name).alias(f"__k_{i}") for i, name in enumerate(keys)])
            sizes = groups.agg(F.count(F.lit(1)).alias("n"))
            row = sizes.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys")).first()
            seen = seen.withColumn("duplicate_keys", F.lit(row.duplicate_keys).cast("bigint"))
        else:
            seen = seen.withColumn("duplicate_keys", F.lit(0).cast("bigint"))
        return _judged(seen, self._spec, len(copy.columns))


def inline_quality(df: DataFrame, spec: InlineSpec) -> DataFrame:
    """The inline report as one row: counts, the outcome of each check, the verdict.

    Errors are duplicated key values plus failing rows of the three row checks. The
    column count and the row range fail the load but add no errors; when there are
    errors and they stay within ``max(1, rows * error_rate)``, the verdict is
    *within tolerance* even so.
    """
    return _judged(inline_metrics(df, spec), spec, len(df.columns))


def _judged(counted: DataFrame, spec: InlineSpec, columns: int) -> DataFrame:
    bounds = spec.row_bounds()
    metrics = counted.select(
        "total_rows",
        "duplicate_keys",
        "null_rows",
        "length_rows",
        "regex_rows",
        F.lit(columns).alias("column_count"),
    )

    def outcome(asked: bool, failed: Column) -> Column:
        if not asked:
            return F.lit(NOT_CHECKED)
        return F.when(failed, F.lit(FAIL)).otherwise(F.lit(PASS))

    total = F.col("total_rows")
    wrong_size = F.col("column_count") != F.lit(spec.column_size)
    out_of_range = (total < bounds[0]) | (total > bounds[1]) if bounds else F.lit(False)
    checks = {
        "key_check": outcome(bool(spec.primary_columns), F.col("duplicate_keys") > 0),
        "column_count_check": outcome(spec.column_size > 0, wrong_size),
        "rows_range_check": outcome(bounds is not None, out_of_range),
        "null_check": outcome(bool(spec.not_null), F.col("null_rows") > 0),
        "length_check": outcome(bool(spec.lengths), F.col("length_rows") > 0),
        "regex_check": outcome(bool(spec.patterns), F.col("regex_rows") > 0),
    }
    errors = F.col("duplicate_keys") + F.col("null_rows") + F.col("length_rows") + F.col("regex_rows")
    limit = F.greatest(total * F.lit(float(spec.error_rate)), F.lit(1.0))
    judged = metrics.withColumns(
        {**checks, "error_count": errors, "error_limit": limit}
    )
    return judged.withColumn("result", verdict("error_count", "error_limit", list(checks)))


def verdict(errors: str, limit: str, checks: Sequence[str]) -> Column:
    failed = F.lit(False)
    for name in checks:
        failed = failed | (F.col(name) == FAIL)
    tolerated = (F.col(errors) > 0) & (F.col(errors) <= F.col(limit))
    return (
        F.when(tolerated, F.lit(WITHIN_TOLERANCE)).when(failed, F.lit(FAIL)).otherwise(F.lit(PASS))
    )


def gate(report: Mapping) -> None:
    """End the load when the row of its inline report says *fail*."""
    if report["result"] == FAIL:
        failed = [name for name, value in report.items() if name.endswith("_check") and value == FAIL]
        raise QualityError(f"quality checks failed: {', '.join(failed)}; report {dict(report)}")


def rule_quality(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Violations per rule and column, zero included, in the order of the report.

    SQL and pattern rules count rows where the predicate is not true, NULL included. A
    pattern may match anywhere in the value. The built-in key rule counts all rows of
    duplicated keys, which differs from the inline check; NULL is a key value.

    The input is read once whatever the list holds. Without a key rule all counts are one
    aggregate; with key rules their keys are the grouping sets of one, in which the row
    flags are summed on the way along the first set.
    """
    ordered = _ordered_checks(rules)
    if not ordered:
        return df.sparkSession.createDataFrame(
            [], "seq int, rule_code string, rule_name string, rule_type string, "
            "column_name string, violations bigint"
        )
    row_checks = [check for check in ordered if check["type"] != RULE_BUILT_IN]
    key_checks = [check for check in ordered if check["type"] == RULE_BUILT_IN]
    failing = {f"n_{check['seq']}": ~F.coalesce(check["ok"], F.lit(False)) for check in row_checks}
    if key_checks:
        counts = _keyed_counts(df, key_checks, failing)
    else:
        counts = df.agg(*[F.count_if(flag).alias(name) for name, flag in failing.items()])
    entries = [_entry(check, F.coalesce(F.col(f"n_{check['seq']}"), F.lit(0))) for check in ordered]
    return counts.select(F.inline(F.array(*entries)))


def _keyed_counts(
    df: DataFrame, key_checks: Sequence[Mapping], failing: Mapping[str, Column]
) -> DataFrame:
    """One row: per key rule the rows of duplicated keys, per row rule the failing rows.

    A row meets one grouping set per distinct key. The set's number comes from
    ``grouping_id``, so a key column that is NULL is told from one that is not in the set.
    """
    texts = list(dict.fromkeys(name for check in key_checks for name in check["keys"]))
    names = {text: f"__k_{i}" for i, text in enumerate(texts)}
    rows = df.select(
        *[F.expr(text).alias(name) for text, name in names.items()],
        *[flag.alias(f"__f_{name}") for name, flag in failing.items()],
    )
    sets = list(dict.fromkeys(frozenset(check["keys"]) for check in key_checks))
    # The bits of grouping_id, first column highest, are 1 for what a set leaves out.
    bits = {text: 1 << (len(texts) - 1 - i) for i, text in enumerate(texts)}
    numbers = {own: sum(bit for text, bit in bits.items() if text not in own) for own in sets}
    per_key = rows.groupingSets(
        [[F.col(names[text]) for text in texts if text in own] for own in sets],
        *[F.col(name) for name in names.values()],
    ).agg(
        F.grouping_id().alias("__set"),
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(f"__f_{name}")).alias(f"__c_{name}") for name in failing],
    )

    def in_set(own: frozenset) -> Column:
        return F.col("__set") == numbers[own]

    duplicated = [
        F.sum(F.when(in_set(frozenset(check["keys"])) & (F.col("__n") > 1), F.col("__n"))).alias(f"n_{check['seq']}")
        for check in key_checks
    ]
    flagged = [F.sum(F.when(in_set(sets[0]), F.col(f"__c_{name}"))).alias(name) for name in failing]
    return per_key.agg(*duplicated, *flagged)


def _entry(check: Mapping, count: Column) -> Column:
    return F.struct(
        F.lit(check["seq"]).alias("seq"),
        F.lit(check["code"]).alias("rule_code"),
        F.lit(check["name"]).alias("rule_name"),
        F.lit(check["type"]).alias("rule_type"),
        F.lit(check["column"]).alias("column_name"),
        count.cast("bigint").alias("violations"),
    )


def _ordered_checks(rules: Sequence[Mapping]) -> list[dict]:
    """Rules as single checks: built-in first, then SQL, then pattern."""
    checks = []
    for kind in (RULE_BUILT_IN, RULE_SQL, RULE_REGEX):
        for rule in rules:
            if str(rule.get("rule_type", "")) == kind:
                checks.extend(_rule_checks(rule, kind))
    for seq, check in enumerate(checks):
        check["seq"] = seq
    return checks


def _rule_checks(rule: Mapping, kind: str) -> list[dict]:
    text = str(rule.get("rule_expr", ""))
    columns = field_names(rule.get("quality_columns"))
    if not columns:
        raise ValueError(f"quality rule without quality_columns: {dict(rule)}")
    base = {"code": str(rule.get("rule_code", "")), "name": str(rule.get("rule_name", "")), "type": kind}
    if kind == RULE_BUILT_IN:
        if text.strip().lower() != PRIMARY_KEY_CHECK:
            raise ValueError(f"no built-in rule {text!r}")
        return [{**base, "column": ",".join(columns), "keys": columns}]
    checks = []
    for column in columns:
        if kind == RULE_SQL:
            ok = F.expr(text.replace("$column", column))
        else:
            ok = F.expr(column).cast("string").rlike(text)
        checks.append({**base, "column": column, "ok": ok})
    return checks


def quality_report(violations: DataFrame) -> DataFrame:
    """The violated rules with a message each, and last a row with the verdict."""
    message = F.format_string(
        "column %s: rule %s: %d rows do not conform",
        F.col("column_name"),
        F.col("rule_name"),
        F.col("violations"),
    )
    broken = violations.filter(F.col("violations") > 0).select(
        "seq", "rule_code", "rule_name", "column_name", "violations", message.alias("message")
    )
    ending = violations.agg(
        F.coalesce(F.max("seq"), F.lit(-1)).alias("last"),
        F.count_if(F.col("violations") > 0).alias("broken"),
    ).select(
        (F.col("last") + 1).alias("seq"),
        F.lit("result").alias("rule_code"),
        F.lit(None).cast("string").alias("rule_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("broken").alias("violations"),
        F.when(F.col("broken") > 0, F.lit(FAIL)).otherwise(F.lit(PASS)).alias("message"),
    )
    return broken.unionByName(ending)
