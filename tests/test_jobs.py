import json
import threading
import time
import uuid

import pytest
from conftest import rows

from millrace.operators.quality import QualityError
from millrace.plans.jobs import (
    input_fields,
    input_options,
    output_options,
    run_apply,
    run_date,
    run_etl,
    run_multi,
    run_quality,
    run_rules,
    run_sql,
)
from millrace.plans.script import run_script, statements, view_names, view_of
from millrace.session import cancel_group, job_group, private_session, scratch_dir, shared_dir
from millrace.streaming.ingest import stop_stream

HDFS = {"data_source_type": "HDFS"}
TLI = {"params": '{"ETL_DATE": "2020-01-26"}', "job_context": "j"}


@pytest.fixture
def source(spark, folder):
    path = f"{folder}/in"
    spark.range(10).selectExpr("id", "cast(id * 2 as string) as name", "id % 3 as g").write.parquet(path)
    return path


def info(path, **more):
    return {"file_type_input": "parquet", "data_sources_params_input": json.dumps({"paths": path}), **more}


MAPPING = [
    {"column_expr": "id + 1", "column_alias": "id", "column_type": ""},
    {"column_expr": "name", "column_alias": "name"},
    {"column_expr": "$etl_date", "column_alias": "etl_date", "column_type": "date"},
]


def test_defaults():
    options = output_options({"url": "u"}, {"data_sources_params_output": '{"paths": "/p", "x": 1}'})
    assert options == {
        "url": "u",
        "paths": "/p",
        "x": 1,
        "fileType": "csv",
        "encoding": "utf-8",
        "sep": ",",
        "header": "false",
        "merge": "-1",
        "model": "append",
        "partition_by": "",
    }
    assert input_options({}, {})["header"] == "false"
    assert input_fields({"data_sources_file_columns": "", "data_sources_table_columns": "a,b"}) == ["a", "b"]
    assert input_fields({"data_sources_file_columns": "c", "data_sources_table_columns": "a"}) == ["c"]
    assert run_date({"tli": TLI}) == "2020-01-26" and run_date({}) is None


def test_single_source(spark, source, folder):
    task = {
        "tli": TLI,
        "dsi_Input": HDFS,
        "dsi_Output": HDFS,
        "etlTaskInfo": info(
            source,
            data_sources_filter_input="1=1",
            column_data_list=MAPPING,
            file_type_output="csv",
            sep_output="|",
            header_output="true",
            merge_output="1",
            data_sources_params_output=json.dumps({"paths": f"{folder}/out"}),
        ),
    }
    run_etl(spark, task)
    run_etl(spark, task)  # the default mode appends
    back = spark.read.csv(f"{folder}/out", sep="|", header=True)
    assert back.columns == ["id", "name", "etl_date"]
    assert back.count() == 20
    assert back.filter("id = 10 and name = '18' and etl_date = '2020-01-26'").count() == 2


def test_apply_reads_its_own_block(spark, source):
    task = {"dsi_Input": HDFS, "etlApplyTaskInfo": info(source, data_sources_filter_input="id < 2")}
    assert run_apply(spark, task).frame.count() == 2


def test_gate_stops_the_task(spark, source, folder):
    checks = [{"column_expr": "id", "column_alias": "id", "column_name": "name", "column_length": "1"}]
    block = info(
        source,
        enable_quality="on",
        error_rate="0.1",
        column_data_list=checks,
        file_type_output="parquet",
        data_sources_params_output=json.dumps({"paths": f"{folder}/out"}),
    )
    reports = {"data_source_type": "hdfs", "paths": f"{folder}/reports"}
    task = {"tli": TLI, "dsi_Input": HDFS, "dsi_Output": HDFS, "dsi_Report": reports, "etlTaskInfo": block}
    with pytest.raises(QualityError):
        run_etl(spark, task)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/out")
    block["error_rate"] = "0.5"
    result = run_etl(spark, task)
    assert result.quality["result"] == "within_tolerance"
    assert spark.read.parquet(f"{folder}/out").count() == 10
    kept = spark.read.parquet(f"{folder}/reports").select("etl_date", "job_context", "length_rows", "result")
    assert rows(kept) == [("2020-01-26", "j", 5, "fail"), ("2020-01-26", "j", 5, "within_tolerance")]


def test_dedup_and_repartition(spark, source):
    block = info(source, duplicate_columns="g", duplicate_order_by="id desc", repartition_num_input="3")
    frame = run_etl(spark, {"dsi_Input": HDFS, "etlTaskInfo": block}).frame
    assert rows(frame.select("id")) == [(7,), (8,), (9,)]
    assert frame.rdd.getNumPartitions() == 3


def test_task_options_stay_in_the_task(spark, source):
    store = {**HDFS, "spark.sql.shuffle.partitions": "7", "spark.executor.memory": "1g"}
    result = run_etl(spark, {"dsi_Input": store, "etlTaskInfo": info(source)})
    assert result.session.conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert result.session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_stream_source(spark, folder):
    messages = ['{"n": 1, "d": {"t": "a"}}', '{"n": 2, "d": {"t": "b"}}', '{"n": 3}']
    spark.createDataFrame([(m,) for m in messages], "value string").write.text(f"{folder}/in")
    job = f"job_{uuid.uuid4().hex}"
    output = {"paths": f"{folder}/out", "batch_path": True}
    task = {
        "tli": {**TLI, "job_id": job},
        "dsi_Input": {"data_source_type": "flume", "paths": f"{folder}/in"},
        "dsi_Output": HDFS,
        "etlTaskInfo": {
            "data_sources_file_columns": "n,d.t",
            "data_sources_params_input": json.dumps({"msgType": "json", "checkpoint": f"{folder}/progress"}),
            "data_sources_filter_input": "kind is not null",
            "column_data_list": [
                {"column_expr": "n", "column_alias": "n", "column_type": "int"},
                {"column_expr": "d.t", "column_alias": "kind"},
                {"column_expr": "$etl_date", "column_alias": "day"},
            ],
            "file_type_output": "parquet",
            "data_sources_params_output": json.dumps(output),
        },
    }
    result = run_etl(spark, task)
    result.stream.processAllAvailable()
    assert stop_stream(job)
    found = spark.read.parquet(f"{folder}/out").select("n", "kind", "day")
    assert rows(found) == [("1", "a", "2020-01-26"), ("2", "b", "2020-01-26")]


def test_functions_of_the_caller(spark, source):
    from pyspark.sql.functions import udf

    functions = {"plus": udf(lambda n: n + 100, "bigint")}
    mapping = [{"column_expr": "plus(id)", "column_alias": "n"}]
    task = {"dsi_Input": HDFS, "etlTaskInfo": info(source, column_data_list=mapping)}
    assert run_etl(spark, task, functions).frame.agg({"n": "min"}).first()[0] == 100
    with pytest.raises(Exception, match="UNRESOLVED_ROUTINE"):
        run_etl(spark, task)
    script = "create temporary view t as select 5 as id;\nselect plus(id) as n from t"
    assert rows(run_sql(spark, {"sqlTaskInfo": {"etl_sql": script}}, functions).frame) == [(105,)]


def multi(source, script, context=("left one", "right"), **more):
    return {
        "tli": TLI,
        "dsi_EtlInfo": [
            {"dsi_Input": HDFS, "etlTaskInfo": info(source, etl_context=c, column_data_list=MAPPING)} for c in context
        ],
        "etlMoreTaskInfo": {"etl_sql": script, **more},
    }


SCRIPT = (
    "--table left one=a;\r\n--table right = b;\r\n"
    "create temporary view big as select * from a where id > 5;\r\n\r\n;\r\n"
    "select big.id, b.name, $x_etl_date as d from big left semi join b on big.id = b.id join b using (id)"
)


def test_multi_source(spark, source):
    script = SCRIPT.replace("left semi join b on big.id = b.id ", "")
    result = run_multi(spark, multi(source, script, drop_tmp_tables="big"))
    assert rows(result.frame)[0] == (6, "10", "2020-01-26")
    assert result.frame.count() == 5
    assert not [t for t in result.session.catalog.listTables() if t.isTemporary]


def test_multi_needs_a_view_for_every_source(spark, source):
    with pytest.raises(ValueError, match="--table right"):
        run_multi(spark, multi(source, "--table left one=a;\nselect 1"))
    with pytest.raises(ValueError, match="no statement"):
        run_multi(spark, multi(source, "", context=()))


def test_streams_are_refused(spark, source):
    task = multi(source, SCRIPT)
    task["dsi_EtlInfo"][0]["dsi_Input"] = {"data_source_type": "kafka"}
    with pytest.raises(ValueError, match="stream"):
        run_multi(spark, task)
    with pytest.raises(ValueError, match="stream"):
        run_rules(spark, {**task, "etlDroolsTaskInfo": {"more_task": "ETL"}})
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="stream"):
        run_script(private_session(spark), "select * from s", {"s": stream})


def test_script_parts():
    assert statements("select 1;\n\n;\nselect ';' as x;\r\nselect 3;") == ["select 1", "select ';' as x", "select 3"]
    assert statements("--table a=b;\n--table c=d\nselect 1") == ["select 1"]
    assert view_names("--table a b=v;\n--table c = w \nselect 1") == {"a b": "v", "c": "w"}
    with pytest.raises(ValueError):
        view_names("--table nothing;\n")
    assert view_of("name#v", {}, hashed=True) == "v"
    with pytest.raises(ValueError, match="#"):
        view_of("name", {}, hashed=True)


def test_sql_task(spark, source, folder):
    block = {
        "etl_sql": f"create temporary view t using parquet options (path '{source}');\nselect max(id) as top from t",
        "file_type_output": "json",
        "data_sources_params_output": json.dumps({"paths": f"{folder}/out"}),
    }
    assert rows(run_sql(spark, {"sqlTaskInfo": block}).frame) == [(9,)]
    run_sql(spark, {"sqlTaskInfo": block, "dsi_Output": HDFS})
    assert rows(spark.read.json(f"{folder}/out")) == [(9,)]
    with pytest.raises(ValueError):
        run_sql(spark, {"sqlTaskInfo": {"etl_sql": " "}})


def test_overwrite_partitions_by_text(spark, source):
    name = f"t_{uuid.uuid4().hex}"
    script = f"""create table {name} (id bigint, p string) using parquet partitioned by (p);
set spark.sql.sources.partitionOverwriteMode=dynamic;
insert overwrite table {name} partition (p) select id, if(id < 5, 'a', 'b') from parquet.`{source}`;
insert overwrite table {name} partition (p) select 99, 'b';
select * from {name}"""
    frame = run_sql(spark, {"sqlTaskInfo": {"etl_sql": script}}).frame
    assert sorted(r["id"] for r in frame.collect()) == [0, 1, 2, 3, 4, 99]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_cross_join_text_is_admitted(spark, source):
    script = f"create temporary view t using parquet options (path '{source}');\nselect count(*) as n from t a, t b"
    assert rows(run_sql(spark, {"sqlTaskInfo": {"etl_sql": script}}).frame) == [(100,)]


RULES = [{"when": "id >= 5", "set": {"dsts": "'true'"}}]


@pytest.mark.parametrize("kind", ["ETL", "MORE_ETL", "SQL"])
def test_rule_task(spark, source, kind):
    task = multi(source, "select * from v", ("n#v",))
    task["sqlTaskInfo"] = {
        "etl_sql": f"create temporary view t using parquet options (path '{source}');\nselect id + 1 as id, name from t"
    }
    task["etlDroolsTaskInfo"] = {
        "more_task": kind,
        "etl_drools": json.dumps(RULES),
        "data_sources_filter_input": "dsts = 'true'",
    }
    frame = run_rules(spark, task).frame
    assert frame.count() == 6
    assert {f.dataType.simpleString() for f in frame.schema} == {"string"}


def test_rule_task_kinds(spark, source):
    with pytest.raises(ValueError, match="more_task"):
        run_rules(spark, {"etlDroolsTaskInfo": {"more_task": "x", "etl_drools": "[]"}})


def test_quality_task(spark, source):
    rule = {"rule_type": 2, "rule_code": "r", "rule_name": "even", "rule_expr": "[02468]$", "quality_columns": "g,id"}
    block = info(source, quality_rule_config=[rule], data_sources_file_columns="id,g")
    found = run_quality(spark, {"dsi_Input": HDFS, "qualityTaskInfo": block}).frame.orderBy("seq").collect()
    assert [(r["column_name"], r["violations"]) for r in found] == [("g", 3), ("id", 5), (None, 2)]
    assert found[-1]["message"] == "fail"


def test_job_group_cancels_and_is_put_back(spark):
    errors = []

    def work():
        try:
            with job_group(spark, "slow", "slow task"):
                spark.range(10**12).selectExpr("sum(length(sha2(cast(id as string), 512))) as s").collect()
        except Exception as error:  # noqa: BLE001
            errors.append(str(error))

    thread = threading.Thread(target=work)
    thread.start()
    tracker = spark.sparkContext.statusTracker()
    deadline = time.monotonic() + 30
    while not tracker.getActiveJobsIds() and time.monotonic() < deadline:
        time.sleep(0.1)
    assert list(tracker.getJobIdsForGroup("slow"))
    cancel_group(spark, "slow")
    thread.join(30)
    assert not thread.is_alive() and errors
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_scratch_is_below_the_shared_folder(spark):
    path = scratch_dir(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/") and path.startswith(named)
    assert scratch_dir(spark, "x") != path
