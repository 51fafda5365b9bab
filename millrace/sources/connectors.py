"""Stores behind connector packages: task keys as options of their Spark formats.

The packages are not part of Spark. These functions only say which format and options
a task means; running them needs the package and the store.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from millrace.operators.keyed import upsert_fields
from millrace.sources.files import spark_options


@dataclass(frozen=True)
class Connection:
    """A Spark format, its options, and what to pass to ``load`` or ``save``."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    settings: dict[str, str] = field(default_factory=dict)


# Format names and default ports of the stores.
KAFKA_FORMAT = "kafka"
ICEBERG_FORMAT = "iceberg"
MONGODB_FORMAT = "mongodb"
ELASTICSEARCH_FORMAT = "org.elasticsearch.spark.sql"
CASSANDRA_FORMAT = "org.apache.spark.sql.cassandra"
KUDU_FORMAT = "kudu"
GREENPLUM_FORMAT = "greenplum"
TIDB_FORMAT = "tidb"
MEMSQL_FORMAT = "memsql"
SOLR_FORMAT = "solr"
REDIS_FORMAT = "org.apache.spark.sql.redis"
DELTA_FORMAT = "delta"
HUDI_FORMAT = "hudi"
REDIS_PORT = "6379"
TIDB_PORT = "4000"
DEFAULT_GROUP = "g1"
TIDB_JDBC = ("jdbc:mysql://", "com.mysql.cj.jdbc.Driver")
MEMSQL_JDBC = ("jdbc:mariadb://", "org.mariadb.jdbc.Driver")


def _need(options: Mapping[str, object], *keys: str) -> list[str]:
    values = []
    for key in keys:
        value = str(options.get(key) or "").strip()
        if not value:
            raise ValueError(f"this store needs {key!r}")
        values.append(value)
    return values


def host_port(url: str, default_port: str = "") -> tuple[str, str]:
    host, mark, port = url.partition(":")
    return host, port if mark else default_port


def two_part_name(name: str) -> tuple[str, str]:
    """``schema.table``."""
    schema, mark, table = name.partition(".")
    if not mark or not schema or not table:
        raise ValueError(f"table {name!r} needs the form schema.table")
    return schema, table


def kafka_source(options: Mapping[str, object]) -> Connection:
    url, topics = _need(options, "url", "paths")
    own = {k: v for k, v in spark_options(options).items() if k.startswith("kafka.") or k in _KAFKA}
    return Connection(
        KAFKA_FORMAT,
        {
            "startingOffsets": "earliest",
            **own,
            "kafka.bootstrap.servers": url,
            "subscribe": topics,
            "kafka.group.id": str(options.get("groupId") or DEFAULT_GROUP),
        },
    )


_KAFKA = (
    "startingOffsets",
    "endingOffsets",
    "failOnDataLoss",
    "maxOffsetsPerTrigger",
    "minPartitions",
)


def kafka_sink(options: Mapping[str, object]) -> Connection:
    url, topic = _need(options, "url", "paths")
    own = {k: v for k, v in spark_options(options).items() if k.startswith("kafka.")}
    return Connection(KAFKA_FORMAT, {**own, "kafka.bootstrap.servers": url, "topic": topic})


def iceberg(options: Mapping[str, object], write: bool = False) -> Connection:
    """A path below ``url`` for the hadoop catalog, a table name for hive."""
    (table,) = _need(options, "paths" if write else "tableName")
    if str(options.get("driver") or "hadoop").lower() == "hive":
        return Connection(ICEBERG_FORMAT, spark_options(options), table)
    (url,) = _need(options, "url")
    return Connection(ICEBERG_FORMAT, spark_options(options), f"{url.rstrip('/')}/{table.lstrip('/')}")


def mongodb(options: Mapping[str, object]) -> Connection:
    url, collection = _need(options, "url", "paths")
    return Connection(
        MONGODB_FORMAT,
        {**spark_options(options), "connection.uri": url, "collection": collection},
    )


def elasticsearch(options: Mapping[str, object]) -> Connection:
    url, index = _need(options, "url", "paths")
    host, port = host_port(url)
    own = spark_options(options)
    nodes = {"es.nodes": own.get("es.nodes", host), "es.port": own.get("es.port", port)}
    if not nodes["es.port"]:
        raise ValueError(f"address {url!r} needs the form host:port")
    return Connection(ELASTICSEARCH_FORMAT, {**own, **nodes}, index)


def cassandra(options: Mapping[str, object]) -> Connection:
    url, name = _need(options, "url", "paths")
    keyspace, table = two_part_name(name)
    host, port = host_port(url)
    settings = {"spark.cassandra.connection.host": host}
    if port:
        settings["spark.cassandra.connection.port"] = port
    return Connection(
        CASSANDRA_FORMAT,
        {**spark_options(options), "keyspace": keyspace, "table": table},
        settings=settings,
    )


def kudu(options: Mapping[str, object]) -> Connection:
    url, table = _need(options, "url", "paths")
    return Connection(KUDU_FORMAT, {"kudu.master": url, "kudu.table": table})


def greenplum(options: Mapping[str, object]) -> Connection:
    url, name = _need(options, "url", "paths")
    chosen = {**spark_options(options), "url": url}
    for key in ("user", "password"):
        if options.get(key):
            chosen[key] = str(options[key])
    if "." in name:
        chosen["dbschema"], chosen["dbtable"] = two_part_name(name)
    else:
        chosen["dbtable"] = name
    return Connection(GREENPLUM_FORMAT, chosen)


def tidb_query(
    options: Mapping[str, object], fields: Sequence[str], where: str | None = None
) -> str:
    """A read is a query over the catalog table."""
    (name,) = _need(options, "paths")
    columns = ",".join(fields) or "*"
    text = f"select {columns} from {name}"
    return f"{text} where {where}" if where and where.strip() else text


def tidb_sink(options: Mapping[str, object]) -> Connection:
    url, name = _need(options, "url", "paths")
    database, table = two_part_name(name)
    host, port = host_port(url, TIDB_PORT)
    return Connection(
        TIDB_FORMAT,
        {
            **spark_options(options),
            "tidb.addr": host,
            "tidb.port": port,
            "tidb.user": str(options.get("user") or "root"),
            "tidb.password": str(options.get("password") or ""),
            "database": database,
            "table": table,
        },
    )


def jdbc_beside(options: Mapping[str, object], address: tuple[str, str]) -> dict[str, object]:
    """Options to reach the store of a connector over JDBC, for its clear statement."""
    prefix, driver = address
    (url,) = _need(options, "url")
    return {**options, "url": prefix + url, "driver": options.get("driver") or driver}


def memsql(options: Mapping[str, object]) -> Connection:
    url, name = _need(options, "url", "paths")
    chosen = {**spark_options(options), "ddlEndpoint": url}
    for key in ("user", "password"):
        if options.get(key):
            chosen[key] = str(options[key])
    return Connection(MEMSQL_FORMAT, chosen, name)


def solr(options: Mapping[str, object]) -> Connection:
    url, collection = _need(options, "url", "paths")
    return Connection(
        SOLR_FORMAT, {**spark_options(options), "zkhost": url, "collection": collection}
    )


def redis(options: Mapping[str, object], write: bool = False) -> Connection:
    """Hashes by key pattern and tables by name; single values, lists and sets have no
    Spark format of their own."""
    url, name = _need(options, "url", "paths")
    kind = str(options.get("data_type") or "string").lower()
    allowed = ("table",) if write else ("hash", "table")
    if kind not in allowed:
        raise ValueError(f"data_type {kind!r} is not one of {', '.join(allowed)}")
    host, port = host_port(url, REDIS_PORT)
    own = {k: v for k, v in spark_options(options).items() if k != "data_type"}
    target = {"keys.pattern": name} if kind == "hash" else {"table": name}
    return Connection(
        REDIS_FORMAT,
        {**own, "host": host, "port": port, "auth": str(options.get("password") or ""), **target},
    )


def hudi_sink(options: Mapping[str, object], columns: Sequence[str], path: str) -> Connection:
    key, precombine = upsert_fields(
        columns,
        str(options.get("recordkey_field_opt_key") or ""),
        str(options.get("precombine_field_opt_key") or ""),
    )
    own = {k: v for k, v in spark_options(options).items() if not k.endswith("_opt_key")}
    return Connection(
        HUDI_FORMAT,
        {
            **own,
            "hoodie.table.name": path.rstrip("/").rsplit("/", 1)[-1],
            "hoodie.datasource.write.recordkey.field": key,
            "hoodie.datasource.write.precombine.field": precombine,
            "hoodie.datasource.write.operation": str(options.get("operation_opt_key") or "upsert"),
        },
        path,
    )
