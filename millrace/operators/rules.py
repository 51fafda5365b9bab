"""Rules that rewrite rows.

A rule is ``{"when": <SQL predicate>, "set": {<column>: <SQL expression>}}``. Rules run
in list order and each sees what the ones before it wrote. If any of them has a
``priority``, they are chained instead: the highest that is due fires first, and a rule is
due again when another changes a column it reads.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.transform import bind_run_date

# How often the rules of one chain may be evaluated in all.
MOST_STEPS = 200

_STRING = re.compile(r"'(?:\\.|''|[^'\\])*'|\"(?:\\.|[^\"\\])*\"")
_NAME = re.compile(r"`((?:[^`]|``)+)`|([^\W\d]\w*)")


def read_rules(rules: str | Sequence[Mapping], run_date: str | None = None) -> list[dict]:
    """Rules from JSON text or a list, with the run date filled in."""
    if isinstance(rules, str):
        if not rules.strip():
            raise ValueError("the rule list is empty")
        rules = json.loads(rules)
    if not rules:
        raise ValueError("the rule list is empty")
    checked = []
    for rule in rules:
        if not rule.get("set"):
            raise ValueError(f"rule without 'set': {dict(rule)}")
        checked.append(
            {
                "when": bind_run_date(rule.get("when", "") or "true", run_date),
                "set": {
                    name: bind_run_date(str(value), run_date)
                    for name, value in rule["set"].items()
                },
                **({"priority": int(rule["priority"])} if rule.get("priority") is not None else {}),
            }
        )
    return checked


def _names(texts: Sequence[str]) -> set[str]:
    """The names in SQL texts, lower-cased, columns and functions alike."""
    found = set()
    for text in texts:
        for quoted_name, name in _NAME.findall(_STRING.sub(" ", text)):
            found.add((quoted_name.replace("``", "`") or name).lower())
    return found


def chain_steps(rules: Sequence[Mapping]) -> tuple[list[int], list[set[str]], list[set[str]]]:
    """The order in which chained rules are evaluated, and the columns each reads and sets.

    At first all rules are due. The due one with the highest priority, earlier in the list
    among equals, is evaluated; what reads a column it sets is due again. A rule that reads
    what it sets itself is not due again by that. Rules that feed one another in a circle
    are refused, so every chain ends.
    """
    reads = [_names([rule["when"], *rule["set"].values()]) for rule in rules]
    sets = [{name.lower() for name in rule["set"]} for rule in rules]
    fed = [{j for j in range(len(rules)) if j != i and own & reads[j]} for i, own in enumerate(sets)]
    left = set(range(len(rules)))
    while free := {i for i in left if not any(i in fed[j] for j in left)}:
        left -= free
    if left:
        raise ValueError(f"rules {sorted(left)} set what one another read, in a circle")
    order = sorted(range(len(rules)), key=lambda i: (-rules[i].get("priority", 0), i))
    due, steps = set(order), []
    while due:
        step = next(i for i in order if i in due)
        steps.append(step)
        if len(steps) > MOST_STEPS:
            raise ValueError(f"the rules need more than {MOST_STEPS} evaluations")
        due = due - {step} | fed[step]
    return steps, reads, sets


def _chained(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """The rules as columns, evaluated in the order of ``chain_steps``.

    A rule that comes more than once has a flag per row that says whether it is due there,
    so a row in which nothing it reads has changed does not fire it again.
    """
    steps, reads, sets = chain_steps(rules)
    names = {name.lower(): name for name in df.columns}
    flags = {i: f"__due_{i}" for i in set(steps) if steps.count(i) > 1}
    if taken := [name for name in flags.values() if name in names]:
        raise ValueError(f"columns {taken} are reserved for chained rules")
    # What any rule sets is text for all of them, from the start.
    start = {}
    for rule in rules:
        for name in rule["set"]:
            known = names.setdefault(name.lower(), name)
            old = quoted(known).cast("string") if known in df.columns else F.lit(None).cast("string")
            start[known] = old
    df = df.withColumns({**start, **{flag: F.lit(True) for flag in flags.values()}})
    for step in steps:
        rule = rules[step]
        fires = F.coalesce(F.expr(rule["when"]), F.lit(False))
        if step in flags:
            fires = fires & F.col(flags[step])
        changed: dict[str, Column] = {}
        moves: dict[str, Column] = {}
        for name, value in rule["set"].items():
            known = names[name.lower()]
            new = F.expr(value).cast("string")
            changed[known] = F.when(fires, new).otherwise(quoted(known))
            moves[name.lower()] = fires & ~quoted(known).eqNullSafe(new)
        for other, flag in flags.items():
            met = [moves[name] for name in sets[step] & reads[other]] if other != step else []
            if other == step or met:
                again = F.lit(False) if other == step else F.col(flag)
                for move in met:
                    again = again | move
                changed[flag] = again
        df = df.withColumns(changed)
    return df.drop(*flags.values())


def apply_rules(
    df: DataFrame, rules: str | Sequence[Mapping], run_date: str | None = None
) -> DataFrame:
    """Rewrite rows by rules; the result is all text, its columns in name order.

    A predicate that is NULL does not fire. A column a rule has written is text for the
    rules after it; a column only rules know starts as NULL. The assignments of one rule
    all read the row as it was before the rule. Rules with a ``priority`` are chained, those
    beside them without one have priority 0; see ``chain_steps``.
    """
    found = read_rules(rules, run_date)
    if any("priority" in rule for rule in found):
        df, found = _chained(df, found), []
    for rule in found:
        fires = F.expr(rule["when"])
        changed = {}
        for name, value in rule["set"].items():
            old = quoted(name).cast("string") if name in df.columns else F.lit(None).cast("string")
            changed[name] = F.when(fires, F.expr(value).cast("string")).otherwise(old)
        df = df.withColumns(changed)
    return df.select(*[quoted(name).cast("string").alias(name) for name in sorted(df.columns)])
