"""Generated rows through the text and key operators, compared with plain Python."""

from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.text import line_fields, literal_pattern, sql_literal
from millrace.operators.cells import scan_cells, to_cells
from millrace.operators.quality import InlineSpec, inline_quality, rule_quality

few = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
word = st.text(alphabet="ab|$^.*+?[]{}()\\/-E, '\"", max_size=6)


def java_fields(line, sep, count):
    """Fields as a split that drops empty fields at the end."""
    parts = line.split(sep)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    if parts == [""] and line:
        parts = []
    return tuple(parts[i] if i < len(parts) else None for i in range(count))


@few
@given(st.lists(word, min_size=1, max_size=20), st.text(alphabet="|$^.*+?[]{}()\\/-E", min_size=1, max_size=3))
def test_literal_split(spark, lines, sep):
    if sep == "\\t":
        return
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = rows(df.select("i", *line_fields(F.col("line"), sep, ["a", "b", "c"])), "i")
    assert [r[1:] for r in found] == [java_fields(line, sep, 3) for line in lines]


@few
@given(word)
def test_literals(spark, text):
    row = spark.range(1).select(
        F.expr(sql_literal(text)).alias("t"), F.lit(text).rlike(f"^{literal_pattern(text)}$").alias("m")
    ).first()
    assert row["t"] == text and row["m"]


key = st.one_of(st.none(), st.sampled_from(["a", "b", "a_b", "b_c", ""]))


@few
@given(st.lists(st.tuples(key, key, st.one_of(st.none(), st.integers(0, 3))), max_size=30))
def test_quality_counts(spark, data):
    df = spark.createDataFrame(data, "x string, y string, n int")
    sizes = Counter((x, y) for x, y, _ in data)
    spec = InlineSpec(primary_columns=["x", "y"], not_null=["x", "n"], lengths={"y": 1}, patterns=[("x", "a.*")])
    found = inline_quality(df, spec).first()
    assert found["total_rows"] == len(data)
    assert found["duplicate_keys"] == sum(n > 1 for n in sizes.values())
    assert found["null_rows"] == sum(x is None or n is None for x, _, n in data)
    assert found["length_rows"] == sum(y is not None and len(y) != 1 for _, y, _ in data)
    assert found["regex_rows"] == sum(x is None or not x.startswith("a") for x, _, _ in data)
    rules = [
        {"rule_type": "3", "rule_code": "k", "rule_expr": "primary_key_check", "quality_columns": "x,y"},
        {"rule_type": "1", "rule_code": "s", "rule_expr": "$column < 2", "quality_columns": "n"},
        {"rule_type": "2", "rule_code": "r", "rule_expr": "b", "quality_columns": "x"},
    ]
    counts = [r["violations"] for r in rule_quality(df, rules).orderBy("seq").collect()]
    assert counts == [
        sum(n for n in sizes.values() if n > 1),
        sum(n is None or n >= 2 for _, _, n in data),
        sum(x is None or "b" not in x for x, _, _ in data),
    ]


@few
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.tuples(key, key), max_size=12))
def test_cells_there_and_back(spark, data):
    df = spark.createDataFrame([(k, *v) for k, v in data.items()], "row_key string, `f:x` string, y string")
    found = {tuple(r) for r in scan_cells(to_cells(df), "f:x,y").select("row_key", "x", "y").collect()}
    assert found == {(k, x or "", y or "") for k, (x, y) in data.items() if x or y}
