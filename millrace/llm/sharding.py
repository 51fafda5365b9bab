"""Documents to shards by a consistent-hash ring with bounded loads."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import written

_BITS = 62
REPEATED = 1 << 16


def ring(spark: SparkSession, shards: int, virtual: int) -> list[tuple[int, int]]:
    """``(position, shard)`` of every virtual node, clockwise. Its size is given by the parameters."""
    shard, copy = (F.col("id") / virtual).cast("int"), F.col("id") % virtual
    nodes = spark.range(shards * virtual).select(
        F.shiftrightunsigned(F.xxhash64(F.lit("ring"), shard, copy), 64 - _BITS).alias("position"),
        shard.alias("shard"),
    )
    return sorted((row.position, row.shard) for row in nodes.collect())


def walk(
    nodes: list[tuple[int, int]], counts: dict[int, int], shards: int, slots: int
) -> list[tuple[int, int, int, int, int]]:
    """``(ring slot, first rank, end rank, shard, first place)`` of every run of keys.

    The keys of a slot belong to the first virtual node at or after the slot, and its
    shard takes them, slot by slot, until it is full. Keys that a full shard could not take
    then go on clockwise to the next node whose shard has room, so they push out no others
    and few keys move when a shard is added. Shard ``s`` holds ``n // shards`` keys, one
    more if ``s < n % shards``, so every key finds a place.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    taken = [0] * shards
    positions = [position for position, _ in nodes]
    runs, over = [], []

    def take(slot: int, low: int, left: int, shard: int) -> int:
        fits = min(left, room[shard] - taken[shard])
        if fits:
            runs.append((slot, low, low + fits, shard, taken[shard]))
            taken[shard] += fits
        return fits

    for slot in sorted(counts):
        at = bisect_left(positions, slot * ((1 << _BITS) // slots))
        fits = take(slot, 0, counts[slot], nodes[at % len(nodes)][1])
        if fits < counts[slot]:
            over.append((slot, at, fits))
    for slot, at, low in over:
        while low < counts[slot]:
            at += 1
            low += take(slot, low, counts[slot] - low, nodes[at % len(nodes)][1])
    return runs


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    virtual: int = 256,
    slots: int = 1 << 14,
) -> DataFrame:
    """One row per document: ``(id, size, text_crc32, shard, slot)``.

    The ring is cut into ``slots`` equal pieces; a document's id, CRC and size give its
    place on it. ``shards * virtual`` virtual nodes lie on the ring. Loads are bounded by
    the row count: every shard gets as many rows as any other, or one less, and rows that
    find their shard full go on clockwise. ``slot`` counts the rows of a shard from 0.

    Only the number of rows per ring slot and the runs that follow from it are held by
    the driver; both are bounded by ``slots`` and ``shards``, not by the documents. A
    shard more moves the keys that its nodes take over, and some of those that find no
    room; the others stay.

    ``size`` is the UTF-8 length plus 8; a null text has CRC 0 and size 8, as has an
    empty one. Null ids have a place like any other id. Repeated rows are counted before
    they are ranked and take neighbouring places; a row that occurs more than ``REPEATED``
    times is written out by several tasks. Other columns are not read. An empty
    table gives an empty result.
    """
    if slots & (slots - 1):
        raise ValueError("slots must be a power of two")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
    )
    place = F.shiftrightunsigned(F.xxhash64("id", "crc", "size"), 64 - _BITS)
    shift = _BITS - (slots.bit_length() - 1)
    keyed = narrow.withColumn("place", place).withColumn("ring_slot", F.shiftright("place", shift).cast("int"))
    rows = written(
        keyed.groupBy("ring_slot", "place", "id", "crc", "size").agg(F.count(F.lit(1)).alias("copies")), "places"
    )
    counts = {r.ring_slot: r.n for r in rows.groupBy("ring_slot").agg(F.sum("copies").alias("n")).collect()}
    # From Arrow: rows of a Python list would be turned by Python workers on the executors.
    runs = np.array(walk(ring(spark, shards, virtual), counts, shards, slots), dtype=np.int64).reshape(-1, 5)
    fields = {"run_slot": pa.int32(), "low": pa.int64(), "high": pa.int64(), "shard": pa.int32(), "place_low": pa.int64()}
    columns = [pa.array(column).cast(kind) for column, kind in zip(runs.T, fields.values())]
    runs = spark.createDataFrame(pa.table(columns, names=list(fields)))
    before = Window.partitionBy("ring_slot").orderBy("place", "id", "crc", "size")
    ranked = rows.withColumn("end", F.sum("copies").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("first", F.col("end") - F.col("copies"))
    hot = ranked.where(F.col("copies") > REPEATED).withColumn("all", F.col("end"))
    hot = hot.withColumn("first", F.explode(F.sequence("first", F.col("all") - F.lit(1), F.lit(REPEATED).cast("long"))))
    hot = hot.withColumn("end", F.least(F.col("first") + F.lit(REPEATED), "all")).repartition("ring_slot", "first")
    ranked = ranked.where(F.col("copies") <= REPEATED).unionByName(hot.drop("all"))
    ranked = ranked.withColumn("rank", F.explode(F.sequence("first", F.col("end") - F.lit(1))))
    found = ranked.join(
        F.broadcast(runs),
        (F.col("ring_slot") == F.col("run_slot")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    return found.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("place_low") + F.col("rank") - F.col("low")).alias("slot"),
    )
