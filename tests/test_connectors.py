"""Option mapping of stores whose connector packages are not here; nothing connects."""

import pytest

from millrace.sources import connectors as c
from millrace.sources import jdbc
from millrace.sources.registry import READERS
from millrace.sinks.registry import WRITERS, key_value

BASE = {"url": "h:1234", "paths": "a.b", "fileType": "csv", "spark.x": "1"}


def test_every_type_is_known():
    assert set(READERS) == set(
        "jdbc hdfs hive hbase es mongodb kafka http redis cassandra sftp kudu 外部上传 flume 外部下载 "
        "greenplum tidb iceberg ftp memsql solr".split()
    )
    assert set(WRITERS) == set(READERS)


def test_kafka():
    source = c.kafka_source({"url": "b:9092", "paths": "t1,t2", "groupId": "g", "kafka.x": "y", "msgType": "json"})
    assert source.options == {
        "startingOffsets": "earliest",
        "kafka.x": "y",
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t1,t2",
        "kafka.group.id": "g",
    }
    assert c.kafka_source(BASE).options["kafka.group.id"] == "g1"
    assert c.kafka_sink(BASE).options == {"kafka.bootstrap.servers": "h:1234", "topic": "a.b"}


def test_documents_and_columns():
    assert c.elasticsearch(BASE) == c.Connection(
        "org.elasticsearch.spark.sql", {"es.nodes": "h", "es.port": "1234"}, "a.b"
    )
    assert c.elasticsearch({**BASE, "es.port": "9"}).options["es.port"] == "9"
    assert c.mongodb({**BASE, "database": "d"}).options == {
        "database": "d",
        "connection.uri": "h:1234",
        "collection": "a.b",
    }
    found = c.cassandra(BASE)
    assert found.options == {"keyspace": "a", "table": "b"}
    assert found.settings == {"spark.cassandra.connection.host": "h", "spark.cassandra.connection.port": "1234"}
    assert c.kudu(BASE).options == {"kudu.master": "h:1234", "kudu.table": "a.b"}
    assert c.solr(BASE).options == {"zkhost": "h:1234", "collection": "a.b"}


def test_databases():
    assert c.greenplum({**BASE, "user": "u"}).options == {
        "url": "h:1234",
        "user": "u",
        "dbschema": "a",
        "dbtable": "b",
    }
    assert "dbschema" not in c.greenplum({**BASE, "paths": "t"}).options
    assert c.tidb_sink(BASE).options == {
        "tidb.addr": "h",
        "tidb.port": "1234",
        "tidb.user": "root",
        "tidb.password": "",
        "database": "a",
        "table": "b",
    }
    assert c.tidb_sink({**BASE, "url": "h"}).options["tidb.port"] == "4000"
    assert c.tidb_query(BASE, ["x", "y"], "x > 1") == "select x,y from a.b where x > 1"
    assert c.tidb_query(BASE, []) == "select * from a.b"
    assert c.memsql(BASE) == c.Connection("memsql", {"ddlEndpoint": "h:1234"}, "a.b")


def test_redis():
    assert c.redis({**BASE, "data_type": "hash"}).options == {
        "host": "h",
        "port": "1234",
        "auth": "",
        "keys.pattern": "a.b",
    }
    assert c.redis({**BASE, "url": "h", "data_type": "table"}, write=True).options["port"] == "6379"
    for options, write in (({}, False), ({"data_type": "list"}, False), ({"data_type": "hash"}, True)):
        with pytest.raises(ValueError, match="data_type"):
            c.redis({**BASE, **options}, write)


def test_table_formats():
    assert c.iceberg({"url": "hdfs://n/w/", "tableName": "d/t"}).path == "hdfs://n/w/d/t"
    assert c.iceberg({"driver": "hive", "tableName": "d.t"}).path == "d.t"
    assert c.iceberg({"driver": "hive", "paths": "d.t"}, write=True).path == "d.t"
    link = c.hudi_sink({"recordkey_field_opt_key": "id"}, ["id", "ts"], "/w/orders")
    assert link.options == {
        "hoodie.table.name": "orders",
        "hoodie.datasource.write.recordkey.field": "id",
        "hoodie.datasource.write.precombine.field": "ts",
        "hoodie.datasource.write.operation": "upsert",
    }
    with pytest.raises(ValueError, match="precombine"):
        c.hudi_sink({}, ["uuid"], "/w/t")


@pytest.mark.parametrize(
    "connect", [c.kafka_source, c.kafka_sink, c.mongodb, c.elasticsearch, c.cassandra, c.kudu, c.greenplum, c.solr, c.redis]
)
def test_address_and_name_are_required(connect):
    for missing in ("url", "paths"):
        with pytest.raises(ValueError, match=missing):
            connect({**BASE, missing: " "})


def test_two_part_names():
    assert c.two_part_name("s.t") == ("s", "t")
    for bad in ("t", ".t", "s."):
        with pytest.raises(ValueError):
            c.two_part_name(bad)


def test_key_value(spark):
    df = spark.createDataFrame([(1, 2.5)], "key bigint, value double")
    assert [tuple(r) for r in key_value(df, value="value").collect()] == [("1", "2.5")]
    assert key_value(df).first()["value"] == '{"key":1,"value":2.5}'


JDBC = {"url": "jdbc:x://h/d", "dbtable": "s.t", "driver": "x.Driver", "user": "u", "password": "p"}
SCAN = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4, "fetchsize": 500}


def test_jdbc_read_options():
    task = {**JDBC, **SCAN, "data_source_type": "jdbc", "sep": ",", "filter.optimize": "false", "merge": "-1"}
    chosen, rest = jdbc.jdbc_read_options(task, "a,b", "a > 1")
    assert chosen == {**JDBC, **{k: str(v) for k, v in SCAN.items()}}
    assert rest == "a > 1"


def test_jdbc_filter_in_the_database():
    task = {**JDBC, "filter.optimize": "TRUE"}
    chosen, rest = jdbc.jdbc_read_options(task, "a,b", "a > 1")
    assert chosen["dbtable"] == "(select a,b from s.t where a > 1) filter_tmp" and rest is None
    assert jdbc.jdbc_read_options(task, "", "a > 1")[0]["dbtable"].startswith("(select * from")
    assert jdbc.jdbc_read_options(task, "a", " ")[0]["dbtable"] == "s.t"


def test_jdbc_query_or_table():
    query = {k: v for k, v in JDBC.items() if k != "dbtable"} | {"query": "select 1"}
    assert jdbc.jdbc_read_options(query)[0]["query"] == "select 1"
    with pytest.raises(ValueError, match="either"):
        jdbc.jdbc_options({**JDBC, "query": "select 1"})
    for missing in ("url", "dbtable", "driver"):
        with pytest.raises(ValueError, match=missing):
            jdbc.jdbc_options({**JDBC, missing: ""})
    assert "driver" not in jdbc.jdbc_options({**JDBC, "driver": ""}, write=True)


class Recorder:
    """Stands for a reader or writer: notes what it is told."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class FakeFrame:
    def __init__(self):
        self.write = Recorder()
        self.sparkSession = None


@pytest.mark.parametrize(("model", "mode"), [("", "append"), ("overwrite", "overwrite"), ("Ignore", "ignore")])
def test_jdbc_write(model, mode):
    frame = FakeFrame()
    jdbc.write_jdbc(frame, {**JDBC, "model": model, "truncate": "true", "batchsize": 10, "sep": ","}, "")
    assert frame.write.calls == [
        ("format", ("jdbc",), {}),
        ("mode", (mode,), {}),
        ("options", (), {**JDBC, "truncate": "true", "batchsize": "10"}),
        ("save", (), {}),
    ]


class FakeJvm:
    """Enough of the JVM for one statement: notes the calls, and may fail on it."""

    def __init__(self, failure=None):
        self.failure, self.log = failure, []
        self.java = self
        self.util = self.lang = self.sql = self

    def Properties(self):
        return Recorder()

    @property
    def Class(self):
        return Recorder()

    @property
    def DriverManager(self):
        return self

    def getConnection(self, url, properties):
        self.log.append(("connect", url, [c[1] for c in properties.calls]))
        return self

    def prepareStatement(self, text):
        self.log.append(("prepare", text))
        return self

    def execute(self):
        if self.failure:
            raise RuntimeError(self.failure)
        self.log.append("execute")

    def close(self):
        self.log.append("close")


class FakeSpark:
    def __init__(self, jvm):
        self._jvm = jvm


def test_clear_statement():
    jvm = FakeJvm()
    jdbc.clear_target(FakeSpark(jvm), JDBC, "delete from t where d = '1'")
    assert jvm.log == [
        ("connect", JDBC["url"], [("user", "u"), ("password", "p")]),
        ("prepare", "delete from t where d = '1'"),
        "execute",
        "close",
        "close",
    ]


def connector_frame(jvm):
    frame = FakeFrame()
    frame.sparkSession = FakeSpark(jvm)
    return frame


@pytest.mark.parametrize(
    ("kind", "url"), [("tidb", "jdbc:mysql://h:1234"), ("memsql", "jdbc:mariadb://h:1234"), ("greenplum", "h:1234")]
)
def test_clear_before_a_connector_writes(kind, url):
    jvm = FakeJvm()
    frame = connector_frame(jvm)
    WRITERS[kind](frame, {**BASE, "user": "u"}, "delete from t")
    assert jvm.log[:3] == [("connect", url, [("user", "u")]), ("prepare", "delete from t"), "execute"]
    names = [call[0] for call in frame.write.calls]
    assert names == ["format", "options", "mode", "save"]
    assert frame.write.calls[2][1] == ("append",)


class FakeReading:
    """A session whose reader notes what it is told."""

    def __init__(self):
        self.read, self.conf = Recorder(), Recorder()


def test_reads_through_a_connector():
    spark = FakeReading()
    READERS["redis"](spark, {**BASE, "data_type": "hash"}, ["name", "age"], None)
    names = [call[0] for call in spark.read.calls]
    assert names == ["format", "options", "schema", "load"]
    assert spark.read.calls[2][1][0].fieldNames() == ["name", "age"]
    spark = FakeReading()
    READERS["cassandra"](spark, BASE, ["name"], None)
    assert [call[0] for call in spark.read.calls] == ["format", "options", "load"]
    assert [call[1] for call in spark.conf.calls] == [
        ("spark.cassandra.connection.host", "h"),
        ("spark.cassandra.connection.port", "1234"),
    ]
    spark = FakeReading()
    READERS["es"](spark, BASE, [], None)
    assert spark.read.calls[-1] == ("load", ("a.b",), {})


def test_stores_without_a_clear_statement():
    jvm = FakeJvm()
    with pytest.raises(ValueError, match="delete_then_append"):
        WRITERS["mongodb"](connector_frame(jvm), BASE, "delete from t where a = 1")
    with pytest.raises(ValueError, match="cleared"):
        WRITERS["kudu"](connector_frame(jvm), BASE, "delete from t")
    frame = connector_frame(jvm)
    WRITERS["mongodb"](frame, BASE, "")
    assert [call[0] for call in frame.write.calls] == ["format", "options", "mode", "save"]
    assert jvm.log == []


def test_clear_statement_failures():
    missing = FakeJvm("Table 't' doesn't exist")
    jdbc.clear_target(FakeSpark(missing), JDBC, "delete from t")
    assert missing.log[-2:] == ["close", "close"]
    broken = FakeJvm("syntax error")
    with pytest.raises(RuntimeError):
        jdbc.clear_target(FakeSpark(broken), JDBC, "delete t")
    assert broken.log[-2:] == ["close", "close"]
