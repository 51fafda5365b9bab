import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.text import full_match, line_fields
from millrace.operators.transform import (
    bind_run_date,
    identity_mapping,
    map_columns,
    rename_all,
    select_fields,
    split_fields,
    strip_family,
)
from millrace.queries import REGISTRY
from millrace.schema import field_names, fields_to_schema, schema_frame
from millrace.session import private_session


def entry(expr, alias, kind=""):
    return {"column_expr": expr, "column_alias": alias, "column_type": kind}


def test_map_null_where_text_does_not_fit(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2024-02-30",)], "v string")
    mapped = map_columns(df, [entry("v", "n", "int"), entry("v", "d", "date"), entry("v", "row_key", "int")])
    assert mapped.schema.simpleString() == "struct<n:int,d:date,row_key:string>"
    assert rows(mapped, F.col("row_key").asc_nulls_first()) == [
        (None, None, None),
        (1, None, "1"),
        (None, None, "2024-02-30"),
        (None, None, "x"),
    ]


def test_map_in_task_session_casts_as_tasks_expect(spark):
    own = private_session(spark)
    df = own.createDataFrame([("3.9", 300)], "v string, n int")
    mapped = map_columns(
        df, [entry("v", "v", "int"), entry("n", "n", "tinyint"), entry("cast('x' as int)", "x")]
    )
    assert rows(mapped) == [(3, 44, None)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_no_mapping_keeps_the_frame(spark):
    df = spark.range(3)
    assert map_columns(df, None) is df
    assert map_columns(df, []) is df


def test_map_keeps_alias_or_expression(spark):
    assert map_columns(spark.range(1), [entry("id + 1", "")]).columns == ["id + 1"]
    with pytest.raises(ValueError):
        map_columns(spark.range(1), [entry("", "a")])


@pytest.mark.parametrize(
    ("text", "bound"),
    [
        ("$etl_date", "'2024-01-31'"),
        ("$site_etl_date", "'2024-01-31'"),
        ("datediff($etl_date, d) + $etl_date", "datediff('2024-01-31', d) + '2024-01-31'"),
        ("$etl_dates", "$etl_dates"),
        ("'cost $5'", "'cost $5'"),
    ],
)
def test_run_date(text, bound):
    assert bind_run_date(text, "2024-01-31") == bound


def test_run_date_is_a_literal(spark):
    odd = r"20'24\x"
    assert rows(map_columns(spark.range(1), [entry("$etl_date", "d")], odd)) == [(odd,)]
    with pytest.raises(ValueError):
        bind_run_date("$etl_date", None)


def test_strip_family():
    mapping = strip_family([entry("cf1:a", "x"), entry("b", "y")])
    assert [m["column_expr"] for m in mapping] == ["a", "b"]


def test_identity_and_select_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "c:d", "e"])
    assert map_columns(df, identity_mapping(["a.b", "c:d"])).columns == ["a.b", "c:d"]
    assert select_fields(df, "c:d,a.b").columns == ["c:d", "a.b"]
    assert select_fields(df, "").columns == df.columns
    assert rename_all(df, "x,y,z").columns == ["x", "y", "z"]


@pytest.mark.parametrize("sep", ["|", "||", ".", "$^", "\\t", "\\E", "a", "*", "[", "?"])
def test_fields_of_a_line(spark, sep):
    real = "\t" if sep == "\\t" else sep
    lines = [real.join(f) for f in (["1", "2", "3"], ["1", "2"], ["1", "", "3"], ["1", "2", "3", "4"])]
    lines += ["", real, "1" + real + real, None]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    parts = df.select("i", *line_fields(F.col("line"), sep, ["x", "y", "z"]))
    assert rows(parts) == [
        (0, "1", "2", "3"),
        (1, "1", "2", None),
        (2, "1", "", "3"),
        (3, "1", "2", "3"),
        (4, "", None, None),
        (5, None, None, None),
        (6, "1", None, None),
        (7, None, None, None),
    ]


def test_a_line_is_split_once(spark):
    fields = line_fields(F.col("line"), "|", ["x", "y", "z"])
    assert [str(field).count("regexp_replace") for field in fields[1:]] == [1, 1]
    assert not any("CASE" in str(field) for field in fields[1:])


def test_each_separator_has_its_own_tasks(spark):
    found = REGISTRY["delimiter_escape"](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() >= 12
    assert found.groupBy("sep").count().count() == 12


def test_split_fields_trims(spark):
    df = spark.createDataFrame([(" a , b ",)], "line string")
    assert rows(split_fields(df, "line", ",", "x,y", trim=True)) == [("a", "b")]


def test_full_match(spark):
    df = spark.createDataFrame([("13",), ("13\n",), ("x13",), ("1|3",), (None,)], "v string")
    found = df.select(full_match(F.col("v"), r"\d+|x").alias("m")).collect()
    assert [r["m"] for r in found] == [True, False, False, False, None]


def test_field_list_to_schema():
    schema = fields_to_schema("name,age, job.money,job.addr.city as c,job.money")
    assert schema.simpleString() == (
        "struct<name:string,age:string,job:struct<money:string,addr:struct<city:string>>>"
    )
    for bad in ("", "a b", "a..b", "a as", "a-b"):
        with pytest.raises(ValueError):
            fields_to_schema(bad)


def test_field_names():
    assert field_names("") == [] and field_names(None) == [] and field_names([""]) == []
    assert field_names(" a, b ") == ["a", "b"]


def test_schema_frame(spark):
    df = spark.createDataFrame([(1, [1.0])], "id int not null, v array<double>")
    assert rows(schema_frame(df)) == [(0, "id", "int", False), (1, "v", "array<double>", True)]
