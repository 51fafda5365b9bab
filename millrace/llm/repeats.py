"""Passages repeated from earlier documents: winnowed seeds, extended to whole windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.joins import release
from millrace.llm.text import Words, chunks, grams, split_words
from millrace.session import written

SEED_WORDS = 5


def _seeds(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and seed hash of every window: the least seed hash among its word runs."""
    value, at = grams(words, SEED_WORDS)
    row = words.row
    first = np.flatnonzero(row[: max(len(row) - window + 1, 0)] == row[window - 1 :]) if len(row) >= window else row[:0]
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = value
    width, span = window - SEED_WORDS + 1, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    # ``least[i]`` covers the seeds i .. i + width - 1 of the row-wise list; a window's
    # seeds all lie in one row, so its first seed finds the right place.
    return first, least[np.searchsorted(at, first)]


def _seed_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 1):
            words = split_words(part.column(1))
            first, seed = _seeds(words, window)
            row = words.row[first]
            fresh = np.ones(len(seed), dtype=bool)
            order = np.lexsort((seed, row))
            row, seed = row[order], seed[order]
            fresh[1:] = (row[1:] != row[:-1]) | (seed[1:] != seed[:-1])
            yield pa.record_batch(
                [part.column(0).take(pa.array(row[fresh])), pa.array(seed[fresh].view(np.int64))],
                names=["id", "seed"],
            )

    return run


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 1):
            words = split_words(part.column(1))
            first, seed = _seeds(words, window)
            value, _ = grams(words, window)
            row = words.row[first]
            lists = part.column(2)
            ends = lists.offsets.to_numpy()
            wanted = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            keep = np.zeros(len(first), dtype=bool)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            for i in range(part.num_rows):
                own = slice(bounds[i], bounds[i + 1])
                keep[own] = np.isin(seed[own], wanted[ends[i] : ends[i + 1]])
            yield pa.record_batch(
                [part.column(0).take(pa.array(row[keep])), pa.array(value[keep].view(np.int64))], names=["id", "window"]
            )

    return run


def _spans(places: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Windows at these first words, merged where they touch: ``(first, end)`` word ranges."""
    if not len(places):
        return []
    places = np.sort(places)
    breaks = np.flatnonzero(places[1:] > places[:-1] + window)
    starts = places[np.concatenate([[0], breaks + 1])]
    ends = places[np.concatenate([breaks, [len(places) - 1]])] + window
    return list(zip(starts.tolist(), ends.tolist()))


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 1):
            found = split_words(part.column(1))
            value, at = grams(found, window)
            bounds = np.searchsorted(at, found.first)
            removed, kept, spans = [], [], []
            for i, (text, gone) in enumerate(zip(part.column(1), part.column(2))):
                own = slice(bounds[i], bounds[i + 1])
                hit = np.empty(0, np.int64)
                if gone.is_valid:
                    marked = gone.values.to_numpy(zero_copy_only=False).view(np.uint64)
                    hit = at[own][np.isin(value[own], marked)] - found.first[i]
                ranges = _spans(hit, window)
                words = (text.as_py() or "").encode().split()
                left, last = [], 0
                for first, end in ranges:
                    left += words[last:first]
                    last = end
                left += words[last:]
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                spans.append([{"first": a, "end": b} for a, b in ranges])
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array(np.diff(found.first), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["id", "n_words", "n_removed", "kept", "spans"],
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """``(id, n_words, n_removed, kept, spans)`` per document.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged. A run of ``window`` words goes if
    it also starts in a document with a smaller id, judged on the input. ``spans`` are the
    repeats, merged to their full length (``first`` and ``end`` word); ``kept`` has the
    other words, joined by one blank.

    * Seeds: every window names the least hash of its ``SEED_WORDS``-word runs, so equal
      windows name equal seeds, and neighbours mostly share one. Seeds that occur under
      one id alone are dropped; they are counted with their least and largest id only.
    * Extension: the windows around a shared seed, which reach up to ``window -
      SEED_WORDS`` words to either side, are compared by a hash of all their words. Each
      distinct window keeps its least id, so a passage that very many documents share
      costs a row per occurrence and no pairs. Whether a window goes depends on it and
      the id alone, so its hash says where: no places are moved.

    Hashes have 64 bits. Null and empty texts have no words. A null id is neither smaller
    nor larger than any other: its rows lose nothing and take nothing. Rows with the same
    id take nothing from each other. Other columns are not read. An empty table gives an
    empty result.
    """
    if window < SEED_WORDS:
        raise ValueError(f"a window has {SEED_WORDS} words at least")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    seeds = texts.where("id is not null").mapInArrow(_seed_rows(window), f"id {kind}, seed long")
    shared = seeds.groupBy("seed").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = shared.where("low < high").select("seed")
    listed = seeds.join(shared, "seed").groupBy("id").agg(F.collect_list("seed").alias("seeds"))
    listed = written(listed, "seeds")
    release(docs.sparkSession)
    windows = texts.join(listed, "id").mapInArrow(_window_rows(window), f"id {kind}, window long")
    windows = written(windows, "windows")
    release(docs.sparkSession)
    first = windows.groupBy("window").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    first = first.where("low < high").select("window", "low")
    found = windows.join(first, "window").where("id > low")
    found = written(found.groupBy("id").agg(F.collect_list("window").alias("gone")), "repeats")
    release(docs.sparkSession)
    cut = texts.join(found, "id", "left").select("id", "text", "gone")
    done = cut.mapInArrow(
        _cut(window),
        f"id {kind}, n_words long, n_removed long, kept string, spans array<struct<first:int,end:int>>",
    )
    return done.withColumnRenamed("id", id_col)
