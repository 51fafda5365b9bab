"""Sessions, job groups and shared scratch folders."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

# For steps whose rows are whole texts or sets: a batch is held by the executor and by its
# Python worker at once.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}

_FIXED = ("CANNOT_MODIFY_CONFIG", "CANNOT_MODIFY_STATIC_CONFIG")

# Tasks carry SQL text written for non-ANSI casts: an uncastable value is NULL, it does
# not end the job, and an insert casts to the type of the table. A task may set the
# options back.
TASK_DEFAULTS = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.storeAssignmentPolicy": "legacy",
    # A hot key compresses well, so its partition looks smaller than it is to work on.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    # Spark 4.1.2 zips the partitions of a union whose inputs are hashed alike, and fails
    # when adaptive execution has joined the partitions of one input only.
    "spark.sql.unionOutputPartitioning": "false",
}


def build_session(
    app_name: str = "millrace",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_options(spark: SparkSession, options: Mapping[str, object] | None) -> None:
    """Set the options that start with ``spark.``; fixed cluster settings are skipped."""
    for key, value in (options or {}).items():
        if not key.startswith("spark."):
            continue
        try:
            spark.conf.set(key, str(value))
        except AnalysisException as error:
            if error.getCondition() not in _FIXED:
                raise
            log.warning("setting %s is fixed once the session runs; left as it is", key)


def private_session(
    spark: SparkSession,
    options: Mapping[str, object] | None = None,
    task: bool = True,
) -> SparkSession:
    """A session with its own settings and temp views on the same cluster.

    ``newSession`` starts from the settings the application was launched with, so
    what the caller changed at run time is carried over first.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            child.conf.set(key, value)
    if task:
        apply_options(child, TASK_DEFAULTS)
    apply_options(child, options)
    return child


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Run a block under other settings and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def job_group(spark: SparkSession, group: str, description: str) -> Iterator[None]:
    """Tag every job of the block, so ``cancel_group`` can end them together."""
    context = spark.sparkContext
    keys = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {key: context.getLocalProperty(key) for key in keys}
    context.setJobGroup(group, description, interruptOnCancel=True)
    try:
        yield
    finally:
        for key, value in before.items():
            context.setLocalProperty(key, value)


def cancel_group(spark: SparkSession, group: str) -> None:
    spark.sparkContext.cancelJobGroup(group)


def hadoop_path(spark: SparkSession, path: str):
    """``(FileSystem, Path)`` of a location, whichever store it lives in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder of this machine stands in only on a local master, where
    driver and executors are one process; it is the same one for the whole application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{tempfile.gettempdir()}/millrace-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh shared folder, deleted by the file system when the driver ends."""
    path = f"{shared_dir(spark)}/millrace-{label}-{uuid.uuid4().hex}"
    store, target = hadoop_path(spark, path)
    store.mkdirs(target)
    store.deleteOnExit(target)
    return path


def written(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The frame written to a scratch folder and read from there.

    What follows starts from the files: it reads them as often as it likes, sees the same
    values each time, and survives lost executors without the work before.
    """
    path = scratch_dir(df.sparkSession, label) + "/data"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
