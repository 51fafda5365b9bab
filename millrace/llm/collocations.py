"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ranking import best_rows
from millrace.llm.text import chunks, grams, hash_spans, mix, randoms, split_words
from millrace.session import written

CHUNK_BYTES = 2 << 20
# Entries of stripes that a task holds before it hands them on.
HELD_ENTRIES = 1 << 20
# A prefix with a larger share of all words is hot: its stripe goes in slices.
HOT_SHARE = 1 / 4096
SLICES = 64
# Bits of the filter that a level leaves for the next: 8 MB, whatever the documents.
FILTER_BITS = 26
_U = np.uint64

_STOPS = np.zeros(256, dtype=bool)
_STOPS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_LETTERS = ~_STOPS
_LETTERS[[0x20, 0x09]] = False


def _word_codes(words) -> tuple[np.ndarray, pa.Array]:
    """Each word's number among the distinct words, told by their bytes, and those words."""
    length = words.end - words.start
    inside = np.repeat(words.start - np.cumsum(length) + length, length) + np.arange(length.sum())
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    held = pa.LargeStringArray.from_buffers(
        len(length), pa.py_buffer(offsets.tobytes()), pa.py_buffer(words.data[inside].tobytes())
    )
    coded = held.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _lang_hash(langs: pa.Array) -> np.ndarray:
    data = langs.cast(pa.large_string())
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1]
    held = np.frombuffer(data.buffers()[2] or b"", dtype=np.uint8)
    return hash_spans(held, offsets[:-1], offsets[1:])


def _gram_bits(words, lang: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter bit of every run of ``size`` words of one row with the row's language, and its first word."""
    value, at = grams(words, size)
    value = mix(value + lang[words.row[at]] * randoms(71, 1)[0])
    return (value >> _U(64 - FILTER_BITS)).astype(np.int64), at


class Filter:
    """Bits of the phrases frequent at one level: none of them is missed, few others pass.

    ``hot`` are the bits of those with more than ``HOT_SHARE`` of all words, so not many.
    """

    def __init__(self, bits: np.ndarray, hot: np.ndarray):
        self.bits, self.hot = bits, hot

    def __call__(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Numbers:
    """Numbers for the distinct texts that a task holds, in the order in which they come."""

    def __init__(self):
        self.known = pa.array([], pa.large_string())

    def of(self, texts: pa.Array) -> np.ndarray:
        """The numbers of distinct texts."""
        found = pc.index_in(texts, value_set=self.known)
        fresh = found.is_null().to_numpy(zero_copy_only=False)
        numbers = found.fill_null(0).to_numpy().astype(np.int32)
        numbers[fresh] = len(self.known) + np.arange(fresh.sum())
        self.known = pa.concat_arrays([self.known, texts.filter(pa.array(fresh))])
        return numbers


def _occurrences(
    texts: pa.Array, langs: pa.Array, size: int, passes: Filter | None, words_of: Numbers, langs_of: Numbers
) -> pa.Table | None:
    """Phrases of ``size`` words of some texts: numbers of language and words, and their count.

    ``hot`` tells whether the words before the last are a hot prefix.

    A phrase whose first or last ``size - 1`` words are not frequent cannot be frequent
    and is left out, for which ``passes`` knows the frequent ones.
    """
    words = split_words(texts, lower=True, letters=_LETTERS)
    coded = langs.dictionary_encode()
    lang = coded.indices.to_numpy()
    row = words.row
    count = len(words.hash) - size + 1
    if count <= 0:
        return None
    # Words of one piece: no stop between them, and one row.
    piece = np.concatenate([[0], np.cumsum(_STOPS[words.data])])[words.start] + row
    begin = np.flatnonzero(piece[:count] == piece[size - 1 :])
    hot = np.ones(len(begin), dtype=np.int8)
    if passes is not None:
        bits, at = _gram_bits(words, _lang_hash(coded.dictionary)[lang], size - 1)
        good = np.zeros(len(words.hash), dtype=bool)
        good[at[passes(bits)]] = True
        begin = begin[good[begin] & good[begin + 1]]
        heavy = np.zeros(len(words.hash), dtype=np.int8)
        heavy[at[np.isin(bits, passes.hot)]] = 1
        hot = heavy[begin]
    if not len(begin):
        return None
    codes, known = _word_codes(words)
    columns = {"lang": lang[row[begin]], "hot": hot, **{f"w{j}": codes[begin + j] for j in range(size)}}
    found = _added([pa.table({**columns, "count": np.ones(len(begin), dtype=np.int64)})])
    # Words of phrases that were left out have no number.
    met = np.zeros(len(known), dtype=bool)
    for j in range(size):
        met[found.column(f"w{j}").to_numpy()] = True
    number = np.zeros(len(known), dtype=np.int32)
    number[met] = words_of.of(known.filter(pa.array(met)))
    own = langs_of.of(coded.dictionary.cast(pa.large_string()))
    return pa.table(
        {
            "lang": own[found.column("lang").to_numpy()],
            "hot": found.column("hot"),
            **{f"w{j}": number[found.column(f"w{j}").to_numpy()] for j in range(size)},
            "count": found.column("count"),
        }
    )


# The words of a stripe are joined by spaces, which none of them holds; counts are 4 bytes each.
_STRIPE = "lang string, prefix string, slice int, words string, counts binary"


def _added(parts: list[pa.Table]) -> pa.Table:
    """Counters of the same keys, all columns but ``count``, added elementwise."""
    keys = [name for name in parts[0].column_names if name != "count"]
    found = pa.concat_tables(parts).combine_chunks().group_by(keys, use_threads=False).aggregate([("count", "sum")])
    return found.select([*keys, "count_sum"]).rename_columns([*keys, "count"])


def _stripes(entries: pa.Table, size: int, words_of: Numbers, langs_of: Numbers) -> Iterator[pa.RecordBatch]:
    """Entries as stripes: one row per prefix, or of a hot prefix per slice of the words after it."""
    last = entries.column(f"w{size - 1}").to_numpy()
    part = (_lang_hash(words_of.known) % _U(SLICES)).astype(np.int32)[last] * entries.column("hot").to_numpy()
    keys = [entries.column("lang").to_numpy(), *(entries.column(f"w{j}").to_numpy() for j in range(size - 1)), part]
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    first = np.flatnonzero(fresh)
    edges = np.append(first, len(order))
    last, counts = last[order], entries.column("count").to_numpy()[order].astype("<u4")
    for low in range(0, len(first), 10_000):
        at = first[low : low + 10_000]
        end = edges[min(low + 10_000, len(first))]
        bounds = np.append(at, end) - at[0]
        before = [words_of.known.take(pa.array(key[at])) for key in keys[1:-1]]
        if len(before) > 1:
            prefix = pc.binary_join_element_wise(*before, pa.scalar(" ", pa.large_string()))
        else:
            prefix = before[0] if before else pa.array([""] * len(at), pa.large_string())
        bounds = bounds.astype(np.int32)
        after = words_of.known.take(pa.array(last[at[0] : end])).cast(pa.string())
        words = pa.ListArray.from_arrays(pa.array(bounds), after)
        held = pa.py_buffer(counts[at[0] : end].tobytes())
        yield pa.record_batch(
            [
                langs_of.known.take(pa.array(keys[0][at])).cast(pa.string()),
                prefix.cast(pa.string()),
                pa.array(keys[-1][at].astype(np.int32)),
                pc.binary_join(words, " "),
                pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((bounds * 4).tobytes()), held]),
            ],
            names=["lang", "prefix", "slice", "words", "counts"],
        )


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by prefix and slice, added elementwise.

    Of each sum come the words counted ``least`` times or more and, as the null word, the
    total of all. What is held between batches is the last prefix's slice alone.
    """
    held, last = None, None
    keys = ["lang", "prefix", "slice", "next"]

    def done(entries: pa.Table) -> Iterator[pa.RecordBatch]:
        total = entries.group_by(["lang", "prefix"], use_threads=False).aggregate([("count", "sum")])
        often = entries.filter(pc.greater_equal(entries.column("count"), least))
        nothing = pa.nulls(len(total), pa.string())
        for words, own, counts in ((often.column("next"), often, "count"), (nothing, total, "count_sum")):
            found = pa.table({"lang": own.column("lang"), "prefix": own.column("prefix"), "next": words, "a": own.column(counts)})
            yield from found.combine_chunks().to_batches(max_chunksize=50_000)

    for batch in batches:
        if not batch.num_rows:
            continue
        words = pc.split_pattern(batch.column(3), " ")
        rows = pc.list_parent_indices(words)
        counts = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype="<u4").astype(np.int64)
        flat = pa.table(
            [*(batch.column(i).take(rows) for i in range(3)), words.flatten(), pa.array(counts)], names=[*keys, "count"]
        )
        end = batch.num_rows - 1
        last = [batch.column(i)[end] for i in range(3)]
        flat = _added([flat] if held is None else [held, flat])
        same = pc.and_(pc.equal(flat.column("lang"), last[0]), pc.equal(flat.column("prefix"), last[1]))
        same = pc.and_(same, pc.equal(flat.column("slice"), last[2]))
        held = flat.filter(same)
        yield from done(flat.filter(pc.invert(same)))
    if held is not None:
        yield from done(held)


def _level(docs: DataFrame, size: int, passes, least: int) -> DataFrame:
    """Merged stripes of the prefixes of ``size - 1`` words: ``(lang, prefix, next, a)``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if passes is None else Filter(*passes.value)
        parts, held, words_of, langs_of = [], 0, Numbers(), Numbers()
        for part in chunks(batches, 1, CHUNK_BYTES):
            found = _occurrences(part.column(1), part.column(0), size, known, words_of, langs_of)
            if found is None:
                continue
            parts.append(found)
            held += len(found)
            if held > HELD_ENTRIES:
                parts = [_added(parts)]
                held = len(parts[0])
                if held > HELD_ENTRIES // 2:
                    yield from _stripes(parts[0], size, words_of, langs_of)
                    parts, held, words_of, langs_of = [], 0, Numbers(), Numbers()
        if parts:
            yield from _stripes(_added(parts), size, words_of, langs_of)

    keys = ["lang", "prefix", "slice"]
    stripes = docs.mapInArrow(scan, _STRIPE).repartition(*keys).sortWithinPartitions(*keys)
    return stripes.mapInArrow(lambda batches: _merged(batches, least), "lang string, prefix string, next string, a long")


def _filter(phrases: DataFrame, size: int, heavy: float) -> tuple[np.ndarray, np.ndarray]:
    """The bits of the phrases of ``size`` words, and the numbers of those counted ``heavy`` times or more."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = split_words(batch.column(1), letters=_LETTERS)
            found, _ = _gram_bits(words, _lang_hash(batch.column(0)), size)
            yield pa.record_batch([pa.array(found + 1), batch.column(2)], names=["bit", "a"])

    held = phrases.select("lang", "phrase", "a").mapInArrow(bits, "bit long, a long")
    maps = held.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    found = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for row in maps.collect():
        own = np.frombuffer(row.bits, dtype=np.uint8)
        found[(row.bucket - 1) * len(own) : row.bucket * len(own)] = own
    # Fewer than one for each HOT_SHARE of the words.
    hot = held.where(F.col("a") >= heavy).select("bit").distinct().collect()
    return found, np.array(sorted(row.bit - 1 for row in hot), dtype=np.int64)


def frequent_phrases(
    docs: DataFrame, longest: int = 5, least: int = 100, lang_col: str = "lang", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases ``(lang, size, phrase, prefix, rest, a)`` and words ``(lang, n)`` of each language.

    ``a`` counts the occurrences of a phrase of 1 to ``longest`` words within pieces, overlaps
    included, if they are ``least`` or more. Level by level every prefix has a stripe, a
    counter of the words that follow it; tasks add up their own, and stripes of one prefix
    meet sorted and are added elementwise, those of a hot prefix in slices by the hash of the
    next word. A level counts the phrases alone whose two parts without the last and the first
    word pass the filter of the level before, which loses nothing: neither part is rarer
    than the phrase. The filter has a fixed size; what passes it by chance is counted too.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")
    )
    levels, words, passes = [], None, None
    for size in range(1, longest + 1):
        held = written(_level(docs, size, passes, least), f"stripes-{size}")
        if size == 1:
            words = held.where("next is null").groupBy("lang").agg(F.sum("a").alias("n"))
            heavy = (words.agg(F.sum("n")).first()[0] or 0) * HOT_SHARE
            phrase, rest = F.col("next"), F.lit(None).cast("string")
        else:
            phrase = F.concat_ws(" ", "prefix", "next")
            rest = F.substring_index(phrase, " ", 1 - size)
        level = held.where("next is not null").select(
            "lang", F.lit(size).alias("size"), phrase.alias("phrase"), "prefix", rest.alias("rest"), "a"
        )
        levels.append(level)
        if size < longest:
            bits, hot = _filter(level, size, heavy)
            if not bits.any():
                break
            passes = spark.sparkContext.broadcast((bits, hot))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found, words


def collocations(
    docs: DataFrame,
    longest: int = 5,
    least: int = 100,
    most: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language.

    A-Z are lower-cased. Texts fall into pieces at ``.,;:!?`` and line ends, and those into
    words at spaces and tabs. A phrase of 2 to ``longest`` words that occurs ``a >= least``
    times is cut where ``1000 * a * n div (l * r)`` is lowest, ``l`` and ``r`` counting its two parts
    and ``n`` all words of the language; of equal cuts the first counts. Phrases are left
    out whose words stand in a longer one just as frequent: one more word to either side
    tells, as all between are as frequent too. Products are exact, in decimals of 38 digits.

    A null language is ``und``, a null text empty. Repeated rows count each. Ties of score
    and ``a`` go by the bytes of the phrase. Without a frequent phrase the result is empty.
    """
    found, words = frequent_phrases(docs, longest, least, lang_col, text_col)
    phrases = found.where("size > 1")
    above = phrases.where("size > 2")
    longer = above.select("lang", F.col("prefix").alias("phrase"), "a").unionByName(
        above.select("lang", F.col("rest").alias("phrase"), "a")
    )
    # The stripe of a phrase holds its extensions to the right; those to the left end in it.
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    phrases = phrases.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < a")

    parts = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " "),
            "last": F.array_join(F.slice(parts, F.col("cut") + 1, F.col("size") - F.col("cut")), " "),
        }
    )
    counts = found.select("lang", "phrase", "a")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("last"), F.col("a").alias("r")), ["lang", "last"])
    cuts = cuts.join(words, "lang")
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    least_cut = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(least_cut)
    scored = scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = best_rows(scored, "lang", order, F.col("phrase"), most, "rank")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
