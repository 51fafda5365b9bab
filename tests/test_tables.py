import uuid

import pytest
from conftest import rows

from millrace.session import private_session
from millrace.sinks import write_sink
from millrace.sources import read_source
from millrace.sources.tables import (
    describe_table,
    overwrite_partitions,
    show_databases,
    show_tables,
    write_table,
)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_create_then_insert_by_name(spark, name):
    own = private_session(spark)
    write_table(own.createDataFrame([(1, "a")], "id int, v string"), name)
    assert own.sql(f"describe formatted {name}").filter("col_name = 'Provider'").first()["data_type"] == "orc"
    more = own.createDataFrame([("b", "2", "extra")], "v string, id string, z string")
    write_sink(more, {"type": "hive", "options": {"paths": name}})
    df = read_source(spark, {"type": "hive", "options": {"tableName": name}, "where": "id > 0"})
    assert rows(df) == [(1, "a"), (2, "b")]


def test_modes_on_a_table(spark, name):
    df = spark.range(2)
    write_table(df, name, {"format": "parquet"})
    write_table(df, name, {"model": "ignore"})
    assert spark.table(name).count() == 2
    write_table(df.filter("id = 1"), name, {"model": "overwrite"})
    assert rows(spark.table(name)) == [(1,)]
    with pytest.raises(ValueError):
        write_table(df, name, {"model": "errorifexists"})
    with pytest.raises(ValueError):
        write_table(df, " ")
    with pytest.raises(ValueError):
        read_source(spark, {"type": "hive", "options": {}})


def test_external_partitioned(spark, name, folder):
    df = spark.range(6).selectExpr("id", "id % 2 as p")
    write_table(df, name, {"path": f"{folder}/t", "partitionBy": "p", "format": "parquet"})
    assert spark.read.parquet(f"{folder}/t").count() == 6
    detail = {r[0]: r[1] for r in spark.sql(f"describe formatted {name}").collect()}
    assert detail["Type"] == "EXTERNAL"


def test_overwrite_one_partition(spark, name):
    df = spark.range(10).selectExpr("id", "if(id < 5, '2024-01-01', '2024-01-02') as etl_date")
    write_table(df, name, {"partitionBy": "etl_date"})
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower()
    overwrite_partitions(spark.createDataFrame([("2024-01-02", 99)], "etl_date string, id bigint"), name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [0, 1, 2, 3, 4, 99]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == before


def test_catalog_listings(spark, name):
    write_table(spark.range(1).selectExpr("id", "'x' as p"), name, {"partitionBy": "p"})
    assert "default" in {r["database_name"] for r in show_databases(spark).collect()}
    assert name in {r["table_name"] for r in show_tables(spark, "default").collect()}
    assert rows(describe_table(spark, name).select("col_name", "data_type")) == [("id", "bigint"), ("p", "string")]
