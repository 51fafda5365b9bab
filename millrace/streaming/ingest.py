"""Messages of a stream to rows, batch by batch into any sink."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import line_fields
from millrace.operators.rejects import REASONS, split_rejects, tag_rejects
from millrace.operators.rows import select_rows
from millrace.operators.transform import map_columns
from millrace.schema import field_names, fields_to_schema
from millrace.session import apply_options, shared_dir
from millrace.sinks import write_sink
from millrace.sources.connectors import kafka_source
from millrace.sources.files import full_path
from millrace.sources.tables import overwrite_partitions, write_table

# How often each kind of stream makes a batch, and the default message.
TRIGGERS = {"kafka": "2 seconds", "flume": "5 seconds"}
DEFAULT_MESSAGE = "csv"

# Options of Spark's file stream that a task may set.
FILE_LIMITS = ("maxFilesPerTrigger", "maxBytesPerTrigger", "latestFirst", "maxFileAge", "cleanSource")


def message_stream(spark: SparkSession, kind: str, options: Mapping[str, object]) -> DataFrame:
    """One text column ``value`` per message: a topic, or lines of files as they arrive."""
    if kind == "kafka":
        link = kafka_source(options)
        stream = spark.readStream.format(link.format).options(**link.options).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    limits = {key: str(options[key]) for key in FILE_LIMITS if options.get(key)}
    # By default Spark leaves out files a week older than the newest; here a task asks for that.
    limits.setdefault("maxFileAge", "36500d")
    return spark.readStream.schema("value string").options(**limits).text(full_path(options))


def parse_messages(
    messages: DataFrame,
    fields: str | Sequence[str],
    msg_type: str = DEFAULT_MESSAGE,
    sep: str = ",",
    mapping: Sequence[Mapping[str, str]] | None = None,
    where: str | None = None,
    trim: bool = False,
    run_date: str | None = None,
) -> DataFrame:
    """Rows out of messages, the same for a table and a stream.

    Delimited messages give their fields by position. JSON messages are read by the
    dotted field list, then mapped without types.
    """
    names = field_names(fields)
    if msg_type.lower() == "csv":
        rows = messages.select(*line_fields(F.col("value"), sep, names, trim))
    else:
        parsed = F.from_json("value", fields_to_schema(names)).alias("data")
        rows = messages.select(parsed).select("data.*")
        untyped = [{**entry, "column_type": ""} for entry in mapping or []]
        rows = map_columns(rows, untyped, run_date)
    return select_rows(rows, where)


def tag_messages(
    messages: DataFrame,
    fields: str | Sequence[str],
    mapping: Sequence[Mapping[str, str]],
    where: str | None = None,
    run_date: str | None = None,
) -> DataFrame:
    """JSON messages as ``parse_messages`` reads them, with the reasons against each.

    A message that is not a JSON object, and a value that does not fit the type the mapping
    names for it, are reasons. The filter drops accepted rows alone. See ``split_rejects``.
    """
    broken = "__broken"
    schema = fields_to_schema(field_names(fields)).add(broken, "string")
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": broken})
    rows = messages.select(parsed.alias("data"), F.col("value").alias("__message")).select("data.*", "__message")
    spoiled = F.col(broken).isNotNull() | F.col("__message").isNull()
    tagged = tag_rejects(
        rows, mapping, run_date, [F.when(spoiled, F.lit("the message is no JSON object"))], F.coalesce("__message", F.lit(""))
    )
    if where and where.strip():
        tagged = tagged.where(f"size({REASONS}) > 0 or ({where})")
    return tagged


def batch_writer(sink: Mapping) -> Callable[[DataFrame, int], None]:
    """Hand each batch with rows to a batch sink.

    A batch can come twice after a failure. Three options make the repeat leave no second
    copy: with ``batch_path`` a file sink writes batch ``n`` to its own folder
    ``batch_id=n`` and overwrites it; with ``batch_partition`` a catalog table is
    partitioned by the number in the column of that name, and a batch replaces its own
    partition, so the partitions are the ledger of what has been committed, together with
    the data; with ``batch_column`` a JDBC sink stores the number in that column and clears
    it before the insert. Other sinks get the batch at least once.
    """
    options = dict(sink.get("options", {}))
    by_path = bool(options.pop("batch_path", False))
    partition = str(options.pop("batch_partition", "") or "")
    if partition and str(sink.get("type", "")).strip().lower() != "hive":
        raise ValueError("batch_partition is an option of table sinks")
    column = str(options.pop("batch_column", "") or "")

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        chosen, clear = dict(options), sink.get("clear")
        if partition:
            _replace_partition(batch.withColumn(partition, F.lit(batch_id).cast("bigint")), partition, chosen)
            return
        if by_path:
            chosen["paths"] = f"{str(options['paths']).rstrip('/')}/batch_id={batch_id}"
            chosen["model"] = "overwrite"
        if column:
            batch = batch.withColumn(column, F.lit(batch_id).cast("bigint"))
            clear = f"delete from {options['dbtable']} where {column} = {batch_id}"
        write_sink(batch, {**sink, "options": chosen, "clear": clear})

    return write


def _replace_partition(batch: DataFrame, partition: str, options: Mapping) -> None:
    """Write a batch as the one partition it is, into a table that is made if need be."""
    name = str(options.get("paths") or "")
    spark = batch.sparkSession
    if not spark.catalog.tableExists(name):
        # Made empty first: the data of the first batch are replaced like those of any other.
        write_table(batch.limit(0), name, {**options, "partitionBy": partition, "merge": -1})
    overwrite_partitions(batch, name)


def split_writer(sink: Mapping, rejects: Mapping) -> Callable[[DataFrame, int], None]:
    """Hand the accepted rows of each tagged batch to one sink and the rejected to another."""
    accept, reject = batch_writer(sink), batch_writer(rejects)

    def write(batch: DataFrame, batch_id: int) -> None:
        accepted, rejected = split_rejects(batch)
        accept(accepted, batch_id)
        reject(rejected, batch_id)

    return write


def ingest_stream(spark: SparkSession, stream: Mapping, sink: Mapping) -> StreamingQuery:
    """Start ``{"type", "options", "fields", "mapping", "where", "name", "once"}`` into a sink.

    Progress is kept in ``options["checkpoint"]``, or under the shared folder by stream
    name, and a stream of the same name resumes there. ``once`` reads what is there, then
    stops. With ``rejects``, a sink, JSON messages that are broken or do not fit the types of
    the mapping go there with their reasons; else they become NULLs.
    """
    kind = str(stream.get("type", "")).lower()
    if kind not in TRIGGERS:
        raise ValueError(f"no stream of type {kind!r}")
    options = stream.get("options", {})
    name = str(stream.get("name") or "")
    checkpoint = str(options.get("checkpoint") or "")
    if not checkpoint:
        if not name:
            raise ValueError("a stream needs a checkpoint or a name")
        checkpoint = f"{shared_dir(spark)}/streams/{name}"
    apply_options(spark, options)
    messages = message_stream(spark, kind, options)
    msg_type = str(options.get("msgType") or DEFAULT_MESSAGE)
    fields, mapping, where = stream.get("fields"), stream.get("mapping"), stream.get("where")
    if stream.get("rejects"):
        if msg_type.lower() == "csv" or not mapping:
            raise ValueError("rejects need JSON messages and a mapping")
        rows = tag_messages(messages, fields, mapping, where, stream.get("run_date"))
        write = split_writer(sink, stream["rejects"])
    else:
        rows = parse_messages(
            messages,
            fields,
            msg_type,
            str(options.get("sep") or ","),
            mapping,
            where,
            trim=kind == "flume",
            run_date=stream.get("run_date"),
        )
        write = batch_writer(sink)
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if stream.get("once"):
        query = writer.trigger(availableNow=True).start()
    else:
        query = writer.trigger(processingTime=TRIGGERS[kind]).start()
    if name:
        _STARTED[name] = query
    return query


# Streams by name. Spark lists them per session, and every task has a session of its own.
_STARTED: dict[str, StreamingQuery] = {}


def running_stream(name: str) -> StreamingQuery | None:
    query = _STARTED.get(name)
    return query if query is not None and query.isActive else None


def stop_stream(name: str, finish: bool = True, timeout: float | None = None) -> bool:
    """Stop a stream by name; with ``finish`` the batch it is in ends first.

    If it has not ended within ``timeout`` seconds, the stream is left running and the
    answer is ``False``. Without a timeout it is waited for.
    """
    query = running_stream(name)
    if query is None:
        return False
    deadline = None if timeout is None else time.monotonic() + timeout
    while finish and query.isActive and query.status["isTriggerActive"]:
        if deadline is not None and time.monotonic() > deadline:
            return False
        time.sleep(0.05)
    query.stop()
    _STARTED.pop(name, None)
    return True
