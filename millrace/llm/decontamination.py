"""Benchmark passages inside documents, by size-partitioned MinHash containment search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.joins import small
from millrace.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    """Lower-cased (A-Z) words between white space; none for a null or blank text."""
    return F.regexp_extract_all(
        F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)
    )


def _runs(words: str, size: int, join, kind: str) -> Column:
    """``join`` over every run of ``size`` words, or over the whole of fewer words.

    Never null: Spark would push a null check down to the text and evaluate the words
    in it once per word.
    """
    count = F.size(words)
    at = F.sequence(F.lit(0), F.greatest(count - size, F.lit(0)))
    long_enough = F.transform(at, lambda i: join([F.get(words, i + j) for j in range(size)]))
    whole = F.array(join([F.concat_ws(" ", words)]))
    empty = F.array().cast(f"array<{kind}>")
    return F.when(count >= size, long_enough).when(count > 0, whole).otherwise(empty)


def hashed_shingles(words: str, size: int) -> Column:
    return F.array_distinct(_runs(words, size, lambda parts: F.xxhash64(*parts), "long"))


def string_shingles(words: str, size: int) -> Column:
    return F.array_distinct(_runs(words, size, lambda parts: F.concat_ws(" ", *parts), "string"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document and test item it holds: ``(id, item, item_shingles, shared_shingles)``.

    An item is held when at least ``percent`` of its distinct ``shingle_words``-word
    shingles occur in the document, lower-cased (A-Z), wherever they stand.

    Search: items are partitioned by the size of their shingle set into powers of two.
    An item keeps its ``k`` least shingle hashes (a bottom-k MinHash sketch), ``k`` being
    one more than the shingles that a set of the partition's largest size may miss. So a
    document that holds the item holds one of the ``k`` at least, and nothing is lost.
    Document shingles above the largest hash of all sketches are left out before the
    lookup. Each (document, item) found this way is then verified on the shingles
    themselves.

    A document or item of fewer words has its whole word sequence as one shingle, so a
    very short item is found only in a document with just its words. Empty and null texts
    hold nothing and are held by nothing. Null ids are treated as one more id; rows that
    share an id are one document, whose best row counts; an item id that occurs
    repeatedly stands for each of its texts. Other columns are not read. An empty table
    on either side gives an empty result.
    """
    items = benchmark.select(F.col(item_col).alias("item"), word_array(F.col(item_text_col)).alias("words"))
    items = items.where(F.size("words") > 0).distinct()
    items = items.select(
        "item",
        hashed_shingles("words", shingle_words).alias("hashes"),
        string_shingles("words", shingle_words).alias("shingles"),
    )
    bound = F.pow(F.lit(2), F.ceil(F.log2(F.size("hashes").cast("double")))).cast("int")
    kept = (bound * F.lit(100 - percent) / F.lit(100)).cast("int") + F.lit(1)
    items = items.select(
        "item",
        "shingles",
        F.size("shingles").alias("n"),
        F.slice(F.array_sort("hashes"), F.lit(1), kept).alias("sketch"),
        F.xxhash64("item", "shingles").alias("item_key"),
    )
    items = written(items, "items")
    sketch = items.select("item_key", "n", F.explode("sketch").alias("hash"))
    row = sketch.agg(F.count(F.lit(1)).alias("rows"), F.max("hash").alias("top")).first()

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = texts.select("id", word_array(F.col("text")).alias("words"))
    hashes = words.select("id", hashed_shingles("words", shingle_words).alias("hashes"))
    # Projected first, or every exploded row would carry the whole array. A plain explode
    # infers a filter on its array, which is pushed down like the null check above.
    low = F.filter("hashes", lambda h: h <= F.lit(row["top"]))
    looked = hashes.select("id", F.size("hashes").alias("size"), low.alias("low"))
    looked = looked.select("id", "size", F.explode_outer("low").alias("hash"))
    hits = looked.join(small(sketch, row["rows"]), "hash").where(
        F.lit(100) * F.col("size") >= F.lit(percent) * F.col("n")
    )
    candidates = written(hits.select("id", "item_key").distinct(), "candidates")
    found = candidates.count()
    pairs = candidates.join(small(items.select("item_key", "item", "n", "shingles"), row["rows"]), "item_key")
    pairs = pairs.select(F.col("id").alias("candidate"), "item_key", "item", "n", "shingles")
    wanted = candidates.select(F.col("id").alias("candidate")).distinct()
    held = texts.join(small(wanted, found), F.col("id").eqNullSafe(F.col("candidate"))).select(
        "id", word_array(F.col("text")).alias("words")
    )
    held = written(held.select("id", string_shingles("words", shingle_words).alias("own")), "held")
    checked = held.join(pairs, F.col("id").eqNullSafe(F.col("candidate")))
    shared = F.size(F.array_intersect("own", "shingles"))
    checked = checked.select("id", "item", "item_key", "n", shared.alias("shared"))
    return (
        checked.where(F.lit(100) * F.col("shared") >= F.lit(percent) * F.col("n"))
        .groupBy("id", "item", "item_key")
        .agg(F.max("n").cast("long").alias("n"), F.max("shared").cast("long").alias("shared"))
        .select(
            F.col("id").alias(id_col),
            F.col("item").alias(item_col),
            F.col("n").alias("item_shingles"),
            F.col("shared").alias("shared_shingles"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, with all their columns, that hold no test item (see ``contaminated``)."""
    found = contaminated(docs, benchmark, id_col=id_col, **options)
    found = written(found.select(F.col(id_col).alias("__held")).distinct(), "contaminated")
    return docs.join(small(found, found.count()), docs[id_col].eqNullSafe(found["__held"]), "left_anti")
