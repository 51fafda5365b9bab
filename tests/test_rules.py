import pytest
from conftest import rows

from millrace.operators.rules import apply_rules


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "x"), (5, None), (None, "z")], "id int, name string")


def test_new_column_starts_null_and_all_is_text(df):
    out = apply_rules(df, [{"when": "id >= 5", "set": {"dsts": "'true'"}}])
    assert out.schema.simpleString() == "struct<dsts:string,id:string,name:string>"
    assert sorted(out.collect(), key=str) == sorted(
        [(None, "1", "x"), ("true", "5", None), (None, None, "z")], key=str
    )


def test_rules_see_what_earlier_rules_wrote(df):
    out = apply_rules(
        df,
        [
            {"when": "id = 1", "set": {"name": "concat(name, '!')"}},
            {"when": "name = 'x!'", "set": {"seen": "name", "id": "id + 10"}},
            {"set": {"every": "1"}},
        ],
    )
    assert rows(out.filter("seen is not null")) == [("1", "11", "x!", "x!")]


def test_assignments_of_a_rule_read_the_row_before_it(spark):
    swap = spark.createDataFrame([("a", "b")], "x string, y string")
    assert rows(apply_rules(swap, [{"set": {"x": "y", "y": "x"}}])) == [("b", "a")]


def test_rules_from_json_with_run_date(df):
    out = apply_rules(df, '[{"when": "id = 1", "set": {"day": "$etl_date"}}]', "2024-01-31")
    assert out.filter("day = '2024-01-31'").count() == 1


@pytest.mark.parametrize("bad", ["", "[]", [], [{"when": "true"}], '[{"when": "x", "set": {}}]'])
def test_bad_rules(df, bad):
    with pytest.raises(ValueError):
        apply_rules(df, bad)
