"""Ranked lexical search: documents are scanned by one automaton of the terms of all items."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ranking import best_rows
from millrace.llm.text import buffers, chunks
from millrace.session import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of terms that one automaton may hold; more items are searched block by block.
BLOCK_BYTES = 8 << 20
# Scores held at once: documents times items.
CELLS = 1 << 21

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = 0x20
# What a byte is to the scan: itself, its lower case, or a guard between terms.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = _GUARD
for _first, _last in (("0", "9"), ("a", "z")):
    _FOLD[ord(_first) : ord(_last) + 1] = np.arange(ord(_first), ord(_last) + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)

_MATCH = np.dtype([("end", np.int64), ("term", np.int32)])


class TermScan:
    """An automaton of ``terms``, each guarded on both sides, so only whole terms are met."""

    def __init__(self, terms: list[str]):
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            # One character per UTF-8 byte, as the scanned text has.
            self.automaton.add_word(" " + term.encode().decode("latin-1") + " ", number)
        self.terms = len(terms)
        if terms:
            self.automaton.make_automaton()

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many terms each text has, and (text, term, occurrences) of the automaton's."""
        data, offsets = buffers(texts)
        guarded = np.insert(_FOLD[data], offsets, _GUARD)
        starts = offsets[:-1] + np.arange(1, len(offsets))
        inside = guarded != _GUARD
        first = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        edges = np.append(starts, len(guarded))
        size = np.diff(np.searchsorted(first, edges))
        met = np.empty(0, _MATCH)
        if self.terms and len(first):
            met = np.fromiter(self.automaton.iter(guarded.tobytes().decode("latin-1")), dtype=_MATCH)
        row = np.searchsorted(starts, met["end"] - 1, side="right") - 1
        both, times = np.unique(row * max(self.terms, 1) + met["term"], return_counts=True)
        return size, both // max(self.terms, 1), both % max(self.terms, 1), times


class Block:
    """Some items: their distinct terms, and for each term the items that hold it and how often."""

    def __init__(self, postings: pa.Table):
        items = postings.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
        terms = postings.column("term").combine_chunks().dictionary_encode()
        self.ids, self.terms = items.dictionary, terms.dictionary.to_pylist()
        term = terms.indices.to_numpy()
        order = np.argsort(term, kind="stable")
        self.item = items.indices.to_numpy()[order]
        self.times = postings.column("times").to_numpy()[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))

    def scores(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Rows by items: the sum over an item's terms of what each is worth in the row."""
        total = np.zeros((rows, len(self.ids)), dtype=np.int64)
        held = np.diff(self.first)[term]
        at = np.repeat(self.first[term] - np.cumsum(held) + held, held) + np.arange(held.sum())
        np.add.at(total, (np.repeat(row, held), self.item[at]), np.repeat(value, held) * self.times[at])
        return total


class Best:
    """The ``most`` best documents of each item among those offered so far."""

    def __init__(self, ids: pa.Array, id_type: pa.DataType, most: int):
        self.ids, self.most = ids, most
        self.floor = np.ones(len(ids), dtype=np.int64)
        self.held = pa.table({"item": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "id": pa.array([], id_type)})

    def offer(self, total: np.ndarray, docs: pa.Array) -> None:
        row, item = np.nonzero(total >= self.floor)
        if not len(row):
            return
        met = pa.table({"item": item, "score": total[row, item], "id": docs.take(pa.array(row))})
        met = pa.concat_tables([self.held, met.cast(self.held.schema)])
        met = met.sort_by([("item", "ascending"), ("score", "descending"), ("id", "ascending")])
        item = met.column("item").to_numpy()
        first = np.searchsorted(item, np.arange(len(self.ids) + 1))
        place = np.arange(len(item)) - first[item]
        self.held = met.filter(pa.array(place < self.most)).combine_chunks()
        full = np.flatnonzero(np.diff(first) >= self.most)
        self.floor[full] = met.column("score").to_numpy()[first[full] + self.most - 1]

    def rows(self) -> tuple[pa.Array, pa.Array, pa.Array]:
        held = self.held.combine_chunks()
        item, score, ids = (held.column(i) for i in range(3))
        whole = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        return self.ids.take(whole(item)), whole(ids), whole(score)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, term, times)``: how often each item, all rows of one id, holds each of its terms."""
    folded = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER)
    terms = F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))
    return items.select(F.col(id_col).alias("item"), terms.alias("term")).groupBy("item", "term").agg(
        F.count(F.lit(1)).alias("times")
    )


def _statistics(docs: DataFrame, terms: list[str]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each given term."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = TermScan(held.value)
        holders = np.zeros(automaton.terms, dtype=np.int64)
        some = total = 0
        for part in chunks(batches, 0):
            size, _, term, _ = automaton.counts(part.column(0))
            some, total = some + int((size > 0).sum()), total + int(size.sum())
            holders += np.bincount(term, minlength=automaton.terms)
        met = np.flatnonzero(holders)
        number = np.concatenate([[-1, -2], met])
        yield pa.record_batch({"number": number, "held": np.concatenate([[some, total], holders[met]])})

    counted = docs.select("text").mapInArrow(scan, "number long, held long").groupBy("number").agg(F.sum("held").alias("held"))
    # A row per term of the block, and two more.
    found = {r.number: r.held for r in counted.collect()}
    holders = np.array([found.get(i, 0) for i in range(len(terms))], dtype=np.int64)
    return found.get(-1, 0), found.get(-2, 0), holders


def _search_block(docs: DataFrame, postings: pa.Table, schema, most: int) -> DataFrame:
    spark = docs.sparkSession
    block = Block(postings)
    some, total, holders = _statistics(docs, block.terms)
    weight = np.floor(1000 * np.log((2 * some + 2) / (2 * holders + 1))).astype(np.int64)
    held = spark.sparkContext.broadcast((block, weight))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = held.value
        automaton, best = TermScan(block.terms), None
        width = max(1, CELLS // max(len(block.ids), 1))
        for part in chunks(batches, 1):
            best = best or Best(block.ids, part.column(0).type, most)
            size, row, term, times = automaton.counts(part.column(1))
            # Without a term in any document there is nothing to divide.
            length = 100 - 25 + (25 * size * some) // max(total, 1)
            value = weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * length[row]))
            for low in range(0, part.num_rows, width):
                own = slice(*np.searchsorted(row, [low, low + width]))
                rows = min(width, part.num_rows - low)
                scored = block.scores(row[own] - low, term[own], value[own], rows)
                best.offer(scored, part.column(0).slice(low, rows))
        if best is not None:
            yield pa.record_batch(list(best.rows()), names=["item", "id", "score"])

    return docs.select("id", "text").mapInArrow(scan, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item, rank, id, score)``: the ``most`` documents that score highest for each item.

    Terms are runs of letters and digits, everything beyond ASCII included, with A-Z
    lower-cased. Whole texts are read twice: for the numbers of documents and terms, and
    for the scores. Each task keeps its best ``most`` documents of every item, which is
    exact, so nothing per document is moved or stored.

    Items go to blocks of about ``block_bytes`` of terms, one automaton each, which is what is
    broadcast; every block reads the documents. Rows of one item id are one item, also
    those without id. A null text has no terms. Rows of ``docs`` with one id are documents
    of their own; equal scores go by id, null ids last. Items without a term, and
    documents that score 0, do not occur. Without items or documents the result is empty.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    postings = written(item_terms(items, item_col, item_text_col), "search-terms")
    schema = postings.select("item").schema.add(docs.schema["id"]).add("score", "long")
    held = postings.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()[0]
    blocks = -(-held // block_bytes)
    number = F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))
    found = None
    for block in range(blocks):
        own = postings.where(number == block).orderBy("term", "item").toArrow()
        if own.num_rows:
            part = _search_block(docs, own, schema, most)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    ranked = best_rows(found, "item", order, F.struct("id", "score"), most, "rank")
    return ranked.select("item", F.col("rank").cast("int").alias("rank"), "id", "score")
