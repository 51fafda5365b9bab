"""Null semantics differ from check to check; these frames have what the tables lack."""

import pytest
from conftest import rows

from millrace.operators.quality import (
    FAIL,
    NOT_CHECKED,
    PASS,
    WITHIN_TOLERANCE,
    InlineSpec,
    QualityError,
    gate,
    inline_quality,
    quality_report,
    rule_quality,
)

Q = [
    (1, "ann", "a1"),
    (1, None, "a22"),
    (2, "", None),
    (None, "bob", "xa1x"),
    (None, "eve", "b2"),
    (3, None, "a1"),
]


@pytest.fixture(scope="module")
def q(spark):
    return spark.createDataFrame(Q, "id int, name string, code string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "id int, name string, code string")


def report(df, **spec):
    return inline_quality(df, InlineSpec(**spec)).first().asDict()


def test_nothing_asked(q):
    found = report(q)
    assert found["total_rows"] == 6 and found["result"] == PASS and found["error_count"] == 0
    assert {v for k, v in found.items() if k.endswith("_check")} == {NOT_CHECKED}


def test_duplicate_keys_counts_values(q):
    found = report(q, primary_columns=["id"])
    assert found["duplicate_keys"] == 2  # 1 and NULL
    assert found["key_check"] == FAIL


def test_key_columns_do_not_run_together(spark):
    k = spark.createDataFrame([("a", "b_c"), ("a_b", "c"), (None, "x"), ("x", None)], "a string, b string")
    assert report(k, primary_columns=["a", "b"])["duplicate_keys"] == 0
    twice = k.unionByName(k)
    assert report(twice, primary_columns=["a", "b"])["duplicate_keys"] == 4


def test_null_check_is_any_column(q):
    assert report(q, not_null=["id", "name"])["null_rows"] == 4
    assert report(q, not_null=["name"])["null_rows"] == 2


def test_length_skips_null_and_counts_empty(q):
    assert report(q, lengths={"name": 3})["length_rows"] == 1
    assert report(q, lengths={"name": 3, "code": 2})["length_rows"] == 3


def test_pattern_is_whole_string_and_null_fails(q):
    assert report(q, patterns=[("code", r"[ab]\d")])["regex_rows"] == 3
    assert report(q, patterns=[("code", r"a\d+|xa1x")])["regex_rows"] == 2


@pytest.mark.parametrize(
    ("wanted", "outcome"), [("6", PASS), ("1-6", PASS), ("6-9", PASS), ("7-9", FAIL), ("5", FAIL)]
)
def test_rows_range(q, wanted, outcome):
    found = report(q, rows_range=wanted)
    assert found["rows_range_check"] == outcome == found["result"]


@pytest.mark.parametrize(("size", "outcome"), [(3, PASS), (4, FAIL), (0, NOT_CHECKED)])
def test_column_count(q, size, outcome):
    assert report(q, column_size=size)["column_count_check"] == outcome


def test_tolerance(q):
    one_error = {"lengths": {"name": 3}}
    assert report(q, **one_error, error_rate=0.0)["result"] == WITHIN_TOLERANCE  # at least one
    two_errors = {"not_null": ["name"]}
    assert report(q, **two_errors)["result"] == FAIL
    assert report(q, **two_errors, error_rate=0.34)["result"] == WITHIN_TOLERANCE
    assert report(q, **two_errors, error_rate=0.33)["result"] == FAIL


def test_tolerance_hides_structure(q):
    found = report(q, lengths={"name": 3}, column_size=9, rows_range="100")
    assert found["result"] == WITHIN_TOLERANCE
    assert found["column_count_check"] == found["rows_range_check"] == FAIL
    assert report(q, column_size=9)["result"] == FAIL


def test_everything_in_one_pass_with_a_key(q):
    found = report(
        q, primary_columns=["id"], not_null=["name"], lengths={"code": 2}, patterns=[("code", "a.*")]
    )
    counts = ("total_rows", "duplicate_keys", "null_rows", "length_rows", "regex_rows", "error_count")
    assert tuple(found[c] for c in counts) == (6, 2, 2, 2, 3, 9)


def test_empty_input(empty):
    for keys in ([], ["id"]):
        found = report(empty, primary_columns=keys, not_null=["name"], patterns=[("code", "x")])
        assert found["total_rows"] == 0 and found["error_count"] == 0 and found["result"] == PASS


def test_full_report_reads_once(q):
    spec = InlineSpec(primary_columns=["id"], not_null=["name"], lengths={"code": 2}, patterns=[("code", "a")])
    plan = inline_quality(q, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_gate(q):
    gate(report(q))
    with pytest.raises(QualityError, match="null_check"):
        gate(report(q, not_null=["name"]))


def test_spec_from_task():
    info = {"primary_columns": "a, b", "column_size": "3", "rows_range": "1-5", "error_rate": ""}
    mapping = [
        {"column_name": "a", "column_is_null": "false"},
        {"column_name": "b", "column_is_null": "true", "column_regex": "x+", "column_length": " 4 "},
        {"column_expr": "c"},
    ]
    spec = InlineSpec.from_task(info, mapping)
    assert spec == InlineSpec(["a", "b"], 3, "1-5", ["a"], {"b": 4}, [("b", "x+")], 0.01)


@pytest.mark.parametrize("check", [{"column_is_null": "false"}, {"column_regex": "x"}, {"column_length": "1"}])
def test_check_without_column_name(check):
    with pytest.raises(ValueError, match="column_name"):
        InlineSpec.from_task({}, [{"column_expr": "c", **check}])


def rule(kind, code, expr, columns):
    return {
        "rule_type": kind,
        "rule_code": code,
        "rule_name": f"name {code}",
        "rule_expr": expr,
        "quality_columns": columns,
    }


RULES = [
    rule("2", "r__1", "a1", "code,name"),
    rule("1", "s1", "length($column) >= 2", "name,code"),
    rule("3", "k1", "PRIMARY_KEY_CHECK", "id"),
    rule("3", "k2", "primary_key_check", "id,name"),
    rule("1", "s2", "$column > 0 or $column is null", "id"),
]


def test_rules(q):
    found = rule_quality(q, RULES).select("seq", "rule_code", "column_name", "violations")
    assert rows(found) == [
        (0, "k1", "id", 4),  # rows, not key values
        (1, "k2", "id,name", 0),
        (2, "s1", "name", 3),  # NULL counts
        (3, "s1", "code", 1),
        (4, "s2", "id", 0),
        (5, "r__1", "code", 3),  # a match anywhere; NULL counts
        (6, "r__1", "name", 6),
    ]


def test_row_rules_share_one_scan(q):
    plan = rule_quality(q, [r for r in RULES if r["rule_type"] != "3"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_rules_on_empty_input(empty):
    found = rule_quality(empty, RULES)
    assert {r["violations"] for r in found.collect()} == {0}
    assert [r["message"] for r in quality_report(found).collect()] == [PASS]


def test_report(q):
    found = quality_report(rule_quality(q, RULES[:3])).select("rule_code", "column_name", "violations", "message")
    listed = [tuple(r) for r in found.orderBy("seq").collect()]
    assert listed[0] == ("k1", "id", 4, "column id: rule name k1: 4 rows do not conform")
    assert [r[:2] for r in listed[1:-1]] == [("s1", "name"), ("s1", "code"), ("r__1", "code"), ("r__1", "name")]
    assert listed[-1] == ("result", None, 5, FAIL)


def test_rule_errors(q):
    with pytest.raises(ValueError, match="built-in"):
        rule_quality(q, [rule("3", "k", "other_check", "id")])
    with pytest.raises(ValueError, match="quality_columns"):
        rule_quality(q, [rule("2", "k", "x", "")])
    assert rule_quality(q, []).count() == 0


def test_phone_pattern(spark):
    """A phone-like value among others, as count-if and as a rule."""
    pattern = r"1(3|4|5|6|7|8|9)\d{9}"
    df = spark.createDataFrame([("13812345678",)] + [(f"a{i}",) for i in range(9)], "phone string")
    found = rule_quality(df, [rule("2", "p", pattern, "phone")]).first()
    assert found["violations"] == 9
    assert df.selectExpr(f"count(if(phone rlike r'{pattern}', 1, null)) as n").first()["n"] == 1
