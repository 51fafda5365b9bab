import os
import time

import pytest
from conftest import rows

from millrace.functions.text import quoted
from millrace.session import session_conf
from millrace.sinks import write_sink
from millrace.sinks.files import export_file
from millrace.sources import read_source
from millrace.sources.files import format_name, full_path, newest_file, spark_options


def put(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def read(spark, path, kind="csv", fields="", where="", source="hdfs", **options):
    return read_source(
        spark,
        {"type": source, "options": {"paths": path, "fileType": kind, **options}, "fields": fields, "where": where},
    )


def write(df, path, kind="csv", sink="hdfs", **options):
    return write_sink(df, {"type": sink, "options": {"paths": path, "fileType": kind, **options}})


def test_path():
    assert full_path({"paths": "/a/b"}) == "/a/b"
    assert full_path({"paths": "/a", "url": "hdfs://n:8020/"}) == "hdfs://n:8020/a"
    assert full_path({"paths": "s3a://b/c"}) == "s3a://b/c"
    for bad in ("", "a/b", None):
        with pytest.raises(ValueError):
            full_path({"paths": bad})
    with pytest.raises(ValueError, match="one file system"):
        full_path({"paths": "/a", "url": "n1:2181,n2:2181/cluster"})


def test_options_and_formats():
    kept = spark_options({"paths": "/a", "sep": ",", "spark.x": 1, "user": "u", "quote": None, "multiLine": True})
    assert kept == {"sep": ",", "multiLine": "True"}
    assert [format_name(n) for n in ("paquet", "TXT", None, "orc")] == ["parquet", "text", "csv", "orc"]


LINES = "1||ann||x\n2||bob\n3||||z\n4||d||e||f\n"


@pytest.mark.parametrize("sep", ["||", "$^", ".*", "~|~"])
def test_long_separator_by_field_list(spark, folder, sep):
    path = put(f"{folder}/d.txt", LINES.replace("||", sep))
    assert rows(read(spark, path, fields="id,name,code", sep=sep)) == [
        ("1", "ann", "x"),
        ("2", "bob", None),
        ("3", None, "z"),
        ("4", "d", "e"),
    ]


@pytest.mark.parametrize("sep", ["|", ".", ";"])
def test_one_character_without_header(spark, folder, sep):
    path = put(f"{folder}/d.txt", f"1{sep}a\n2{sep}b\n")
    assert rows(read(spark, path, fields="id,v", sep=sep, where="id > '1'")) == [("2", "b")]
    with pytest.raises(ValueError, match="field list"):
        read(spark, path, sep=sep)


def test_header_names_the_columns(spark, folder):
    path = put(f"{folder}/d.csv", 'id,"a name"\n1,"x, y"\n2,"line\nbreak"\n')
    df = read(spark, path, header="true", multiLine="true")
    assert df.columns == ["id", "a name"]
    assert rows(df) == [("1", "x, y"), ("2", "line\nbreak")]
    listed = read(spark, path, fields="id", header="true", multiLine="true")
    assert listed.columns == ["id", "a name"]  # a mapping may use any column of the file
    typed = read(spark, path, header="true", multiLine="true", schema="id int, v string")
    assert rows(typed.select("id")) == [(1,), (2,)]


def test_tab_spelled_out(spark, folder):
    path = put(f"{folder}/d.tsv", "id\tv\n1\tx\n")
    assert rows(read(spark, path, sep="\\t", header="true")) == [("1", "x")]
    assert read(spark, path, fields="a,b", sep="\\t").columns == ["_c0", "_c1"]
    assert rows(read(spark, path, fields="a,b", sep="\t")) == [("1", "x"), ("id", "v")]


def test_encoding_and_quote(spark, folder):
    path = put(f"{folder}/d.csv", "id,v\n1,'é,ü'\n", "iso-8859-1")
    assert rows(read(spark, path, header="true", encoding="iso-8859-1", quote="'")) == [("1", "é,ü")]


def test_multi_character_header_is_skipped(spark, folder):
    path = put(f"{folder}/d.txt", "id||v\n1||x\n")
    assert rows(read(spark, path, fields="id,v", sep="||", header="true")) == [("1", "x")]


@pytest.mark.parametrize("kind", ["orc", "parquet", "json"])
def test_columnar_prunes_and_filters(spark, folder, kind):
    write(spark.range(10).selectExpr("id", "id * 2 as v", "'x' as w"), f"{folder}/t", kind)
    df = read(spark, f"{folder}/t", kind, "id,v", "v > 10")
    assert sorted(r["id"] for r in df.collect()) == [6, 7, 8, 9]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,v:bigint>" in plan
    if kind != "json":
        assert "GreaterThan(v,10)" in plan


def test_uploaded(spark, folder):
    path = put(f"{folder}/d.csv", "1|a\n2\n")
    assert rows(read(spark, path, fields="id,v", source="外部上传", sep="|")) == [("1", "a"), ("2", None)]
    path = put(f"{folder}/d.json", '{"a": 1, "b": {"c": "x"}}\n')
    df = read(spark, path, "json", "a,b.c", source="外部上传")
    assert rows(df.select("a", "b.c")) == [("1", "x")]


def test_delivered_header_lines(spark, folder):
    path = put(f"{folder}/d.txt", "name|sex|age\nann|f|1\nname|sex|age\n|m|2\nbob|m\nname|x|y\n")
    df = read(spark, path, fields="name,sex,age", source="ftp", sep="|")
    assert rows(df) == [("", "m", "2"), ("ann", "f", "1"), ("bob", "m", None)]


def test_delivered_json(spark, folder):
    path = put(f"{folder}/d.txt", '{"name": "ann", "age": 3}\n{"age": "4"}\nbroken\n')
    df = read(spark, path, "json", "name,age", source="ftp", where="age is not null")
    assert rows(df, "age") == [("ann", "3"), (None, "4")]


def test_delivered_file_types(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    for kind in ("csv", "json", "parquet", "orc", "xml"):
        extra = {"rowTag": "r", "rootTag": "rs"} if kind == "xml" else {"header": "true"}
        name = write(df, f"{folder}/out.{kind}", kind, "sftp", **extra)
        assert name == f"{folder}/out.{kind}" and os.path.isdir(name)
        back = read(spark, name, kind, "id,v", source="sftp", **extra)
        assert {(str(r["id"]), r["v"]) for r in back.collect()} == {("1", "a"), ("2", "b")}


def test_delivered_names_and_types(spark, folder):
    path = put(f"{folder}/d.csv", "h1;h2\n1;a\n")
    assert rows(read(spark, path, fields="id,v", source="sftp", sep=";", header="true")) == [("1", "a")]
    assert read(spark, path, source="sftp", sep=";", header="true").columns == ["h1", "h2"]
    path = put(f"{folder}/e.csv", "1||a\n2\n")
    assert rows(read(spark, path, fields="id,v", source="sftp", sep="||")) == [("1", "a"), ("2", None)]
    path = put(f"{folder}/d.json", '{"id": 1, "o": {"x": 2}}\n')
    df = read(spark, path, "json", "id,o.x", source="sftp")
    assert df.schema.simpleString() == "struct<id:string,o:struct<x:string>>"
    assert read(spark, path, "json", source="sftp").schema["id"].dataType.simpleString() == "bigint"
    path = put(f"{folder}/d.txt", "one\ntwo\n")
    assert rows(read(spark, path, "txt", "line", source="sftp")) == [("one",), ("two",)]


def test_newest_file(spark, folder):
    put(f"{folder}/b.csv", "id\n1\n")
    time.sleep(0.05)
    put(f"{folder}/a.csv", "id\n2\n")
    assert newest_file(spark, folder).endswith("/a.csv")
    assert rows(read(spark, folder, source="sftp", header="true", copyLatest="true")) == [("2",)]
    same = time.time()
    for name in "ab":
        os.utime(f"{folder}/{name}.csv", (same, same))
    assert newest_file(spark, folder).endswith("/b.csv")
    spark.range(5).write.csv(f"{folder}/c.csv")
    assert newest_file(spark, folder).endswith("/c.csv")  # an export of several files
    os.mkdir(f"{folder}/empty")
    with pytest.raises(ValueError):
        newest_file(spark, f"{folder}/empty")


def test_long_separator_write_keeps_nulls_in_place(spark, folder):
    df = spark.createDataFrame([(1, None, "c"), (2, "b", None), (3, "a||b", "")], "id int, x string, y string")
    write(df.coalesce(1), f"{folder}/t", sep="||")
    (part,) = [n for n in os.listdir(f"{folder}/t") if n.startswith("part-")]
    with open(f"{folder}/t/{part}", encoding="utf-8") as f:
        assert f.readline() == "id||x||y\n"
    back = read(spark, f"{folder}/t", fields="id,x,y", sep="||", header="true")
    assert rows(back) == [("1", None, "c"), ("2", "b", None), ("3", "a||b", None)]


def test_modes(spark, folder):
    df = spark.range(3)
    for _ in range(2):
        write(df, f"{folder}/t", "parquet", model="")
    assert spark.read.parquet(f"{folder}/t").count() == 6
    write(df, f"{folder}/t", "parquet", model="ignore")
    assert spark.read.parquet(f"{folder}/t").count() == 6
    with pytest.raises(Exception, match="already exists"):
        write(df, f"{folder}/t", "parquet", model="ErrorIfExists")
    write(df, f"{folder}/t", "parquet", model="Overwrite")
    assert spark.read.parquet(f"{folder}/t").count() == 3


def test_partitioned_write_prunes(spark, folder):
    df = spark.range(100).selectExpr("id", "id % 3 as p", "id % 2 as q")
    write(df, f"{folder}/t", "parquet", partition_by="p,q", merge="auto")
    assert sorted(n for n in os.listdir(f"{folder}/t") if n.startswith("p=")) == ["p=0", "p=1", "p=2"]
    found = read(spark, f"{folder}/t", "parquet", where="p = 1")
    assert found.count() == 33
    assert "PartitionFilters: [isnotnull(p" in found._jdf.queryExecution().executedPlan().toString()


def test_single_file(spark, folder):
    df = spark.range(1000).selectExpr("id", "concat('n', id) as name")
    for _ in range(2):
        assert write(df, f"{folder}/x.orc", "orc", is_single="true", model="overwrite") == f"{folder}/x.orc"
    assert os.path.isdir(f"{folder}/x.orc")
    assert spark.read.orc(f"{folder}/x.orc").count() == 1000
    with pytest.raises(ValueError, match="overwritten"):
        write(df, f"{folder}/x.orc", "orc", is_single="true", model="append")
    with pytest.raises(ValueError, match="partitioned"):
        write(df, f"{folder}/x.orc", "orc", is_single="true", model="overwrite", partition_by="id")


def test_exports_have_one_shape(spark, folder):
    df = spark.range(200000).selectExpr("id", "md5(cast(id as string)) as v")
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        name = export_file(df, f"{folder}/x.csv", "csv", {"header": "true"})
        assert len([n for n in os.listdir(name) if n.startswith("part-")]) > 1
        assert spark.read.csv(name, header=True).distinct().count() == 200000
    assert export_file(df.limit(5), f"{folder}/x.csv", "csv", {"header": "true"}) == name
    assert os.path.isdir(name) and spark.read.csv(name, header=True).count() == 5
    empty = export_file(df.filter("id < 0"), f"{folder}/none.csv", "csv", {"header": "true"})
    assert spark.read.csv(empty, header=True).count() == 0


def test_download(spark, folder):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, v string")
    name = write_sink(df, {"type": "外部下载", "options": {"root_path": folder, "paths": "d/x"}})
    assert name == f"{folder}/d/x.csv"
    lines = {r.value for r in spark.read.text(name).collect()}
    assert lines == {"1,", "2,b", "id,v"}


def test_unknown_and_one_way_types(spark):
    for kind in ("nothing", ""):
        with pytest.raises(ValueError, match="no source"):
            read_source(spark, {"type": kind})
        with pytest.raises(ValueError, match="no sink"):
            write_sink(spark.range(1), {"type": kind})
    with pytest.raises(ValueError, match="written"):
        read_source(spark, {"type": "外部下载"})
    for kind in ("外部上传", "http", "solr", "flume"):
        with pytest.raises(ValueError, match="read"):
            write_sink(spark.range(1), {"type": kind})
    for kind in ("kafka", "flume"):
        with pytest.raises(ValueError, match="stream"):
            read_source(spark, {"type": kind})


def test_any_other_format(spark, folder):
    put(f"{folder}/a.bin", "12345")
    df = read(spark, f"{folder}/a.bin", "binaryFile", "path,length")
    assert df.first()["length"] == 5
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_excel_is_renamed_by_position(spark, folder, monkeypatch):
    """The package is not here, so another format stands in for it."""
    monkeypatch.setattr("millrace.sources.files.EXCEL_FORMAT", "parquet")
    write(spark.range(2).selectExpr("id as A1", "id + 1 as B1"), f"{folder}/t", "parquet")
    df = read(spark, f"{folder}/t", "parquet", "x,y", "y > 1")
    assert rows(df) == [(1, 2)]


def test_nested_write(spark, folder):
    df = spark.createDataFrame(
        [("1", "t", ("n", "f")), ("2", "u", None)], "id string, tag string, other struct<name:string,sex:string>"
    )
    for kind in ("parquet", "orc", "json"):
        write(df, f"{folder}/{kind}", kind)
        assert rows(read(spark, f"{folder}/{kind}", kind).select("id", quoted("tag"), "other.name")) == [
            ("1", "t", "n"),
            ("2", "u", None),
        ]
