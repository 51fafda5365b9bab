import glob
import uuid

import pytest
from conftest import rows

from millrace.streaming.ingest import (
    batch_writer,
    ingest_stream,
    parse_messages,
    running_stream,
    stop_stream,
)


def sink(folder, **options):
    return {"type": "hdfs", "options": {"paths": f"{folder}/out", "fileType": "parquet", "batch_path": True, **options}}


def stream(folder, **more):
    options = {"paths": f"{folder}/in", "checkpoint": f"{folder}/progress", **more.pop("options", {})}
    return {"type": "flume", "options": options, "fields": "id,v", "once": True, **more}


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_csv_body(spark):
    body = messages(spark, "1||a||x", "2", " 3 || c ", None)
    assert rows(parse_messages(body, "id,v", sep="||"), "id") == [
        (None, None),
        (" 3 ", " c "),
        ("1", "a"),
        ("2", None),
    ]
    trimmed = parse_messages(body, "id,v", sep="||", trim=True, where="v is not null")
    assert rows(trimmed) == [("1", "a"), ("3", "c")]


def test_csv_body_ignores_the_mapping(spark):
    mapping = [{"column_expr": "id + 1", "column_alias": "n"}]
    assert parse_messages(messages(spark, "1,a"), "id,v", mapping=mapping).columns == ["id", "v"]


def test_json_body(spark):
    body = messages(spark, '{"name": "n", "job": {"addr": "x", "n": 3}}', '{"name": 5}', "broken")
    mapping = [
        {"column_expr": "upper(name)", "column_alias": "name", "column_type": "int"},
        {"column_expr": "job.addr", "column_alias": "addr"},
        {"column_expr": "$etl_date", "column_alias": "day"},
    ]
    out = parse_messages(body, "name,job.addr,job.n", "json", mapping=mapping, run_date="d", where="name is not null")
    assert rows(out) == [("5", None, "d"), ("N", "x", "d")]
    plain = parse_messages(body, "name,job.n", "json")
    assert plain.schema.simpleString() == "struct<name:string,job:struct<n:string>>"


def test_restart_adds_no_rows(spark, folder):
    messages(spark, "1,a", "2,b").write.text(f"{folder}/in")
    for _ in range(2):
        ingest_stream(spark, stream(folder), sink(folder)).awaitTermination()
        assert spark.read.parquet(f"{folder}/out").count() == 2
    messages(spark, "3,c").write.mode("append").text(f"{folder}/in")
    ingest_stream(spark, stream(folder), sink(folder)).awaitTermination()
    found = spark.read.parquet(f"{folder}/out")
    assert rows(found.select("id", "v")) == [("1", "a"), ("2", "b"), ("3", "c")]
    assert len(glob.glob(f"{folder}/out/batch_id=*")) == 2


def test_repeated_batch_leaves_one_copy(spark, folder):
    batch = spark.range(3).selectExpr("id")
    write = batch_writer(sink(folder))
    for batch_id in (0, 1, 1):
        write(batch, batch_id)
    assert spark.read.parquet(f"{folder}/out").count() == 6
    write(batch.filter("id < 0"), 2)  # an empty batch writes nothing
    assert len(glob.glob(f"{folder}/out/batch_id=*")) == 2


def test_repeated_batch_of_a_table_is_cleared_first(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("millrace.streaming.ingest.write_sink", lambda df, s: seen.append((df.columns, s)))
    options = {"dbtable": "t", "batch_column": "load_no"}
    batch_writer({"type": "jdbc", "options": options})(spark.range(2), 7)
    assert seen == [
        (
            ["id", "load_no"],
            {"type": "jdbc", "options": {"dbtable": "t"}, "clear": "delete from t where load_no = 7"},
        )
    ]


def test_batches_and_filter(spark, folder):
    for i in range(4):
        messages(spark, f"{i},a", f"{i},b").coalesce(1).write.mode("append").text(f"{folder}/in")
    query = ingest_stream(
        spark, stream(folder, where="v = 'b'", options={"maxFilesPerTrigger": 1}), sink(folder)
    )
    query.awaitTermination()
    assert len(glob.glob(f"{folder}/out/batch_id=*")) == 4
    assert rows(spark.read.parquet(f"{folder}/out").select("id", "v")) == [(str(i), "b") for i in range(4)]


@pytest.mark.parametrize("finish", [True, False])
def test_stop_by_name(spark, folder, finish):
    name = f"s_{uuid.uuid4().hex}"
    messages(spark, "1,a").write.text(f"{folder}/in")
    query = ingest_stream(spark, stream(folder, name=name, once=False), sink(folder))
    query.processAllAvailable()
    assert running_stream(name).id == query.id
    assert stop_stream(name, finish)
    assert not query.isActive and running_stream(name) is None
    assert not stop_stream(name)
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_stream_errors(spark, folder):
    with pytest.raises(ValueError, match="no stream"):
        ingest_stream(spark, {"type": "jdbc"}, sink(folder))
    with pytest.raises(ValueError, match="checkpoint or a name"):
        ingest_stream(spark, {"type": "flume", "options": {"paths": folder}}, sink(folder))
