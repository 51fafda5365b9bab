import pytest
from conftest import rows

from millrace.operators.payload import payload_lines, payload_rows

J = [
    (1, '{"a": {"b": [{"x": "1", "y": {"z": 2}}, {"x": "3"}]}}'),
    (2, '{"a": {}}'),
    (3, '{"a": {"b": []}}'),
    (4, '{"a": {"b": "text"}}'),
    (5, "not json"),
    (6, None),
    (7, '{"a": {"b": {"x": "one object"}}}'),
]


def test_rows_below_a_path(spark):
    df = spark.createDataFrame(J, "id int, body string")
    out = payload_rows(df, "body", "x,y.z", "a.b", ["id"]).select("id", "x", "y.z").dropna(subset=["x"])
    assert rows(out) == [(1, "1", "2"), (1, "3", None), (7, "one object", None)]


def test_absent_and_empty_give_no_row(spark):
    df = spark.createDataFrame([J[i] for i in (1, 2, 5)], "id int, body string")
    assert payload_rows(df, "body", "x", "a.b").count() == 0


def test_whole_document(spark):
    df = spark.createDataFrame([('[{"x": 1}, {"x": 2}]',), ('{"x": 3}',)], "body string")
    assert rows(payload_rows(df, "body", "x")) == [("1",), ("2",), ("3",)]
    with pytest.raises(ValueError):
        payload_rows(df, "body", "x", "a[0]")


def test_lines(spark):
    df = spark.createDataFrame([("a|1\nb\nc|3|4",)], "body string")
    assert rows(payload_lines(df, "body", "n,v", "|")) == [("a", "1"), ("b", None), ("c", "3")]
