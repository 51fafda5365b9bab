"""Quality by learned vectors of hashed words, word pairs and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import chunks, hash_spans, mix, randoms, split_words
from millrace.llm.toxicity import held_out

BITS = 17
SIZES = (2, 3, 4)
_U = np.uint64
_SALT = randoms(53, 4) | _U(1)
# The pair of a word with itself, whichever word it is.
_AGAIN = randoms(59, 1)


class Pieces:
    """What some texts are averaged from: tokens, each the mean of the vectors of its buckets.

    Tokens are words and pairs of neighbours. A word's buckets are its own and those of its
    character n-grams between guards; a pair has one bucket. ``words`` and ``pairs`` are
    ``(row, token)``; the buckets of word ``t`` are ``buckets[first[t]:first[t + 1]]``.
    """

    def __init__(self, texts: pa.Array, bits: int):
        words = split_words(texts)
        shift = _U(64 - bits)
        row, one = words.row, words.hash
        self.rows = len(texts)
        # Words of equal hash share everything they have here, so a hash tells them.
        _, place, token = np.unique(one, return_index=True, return_inverse=True)
        self.words = row, token
        start, end = words.start[place], words.end[place]
        length = end - start
        guarded = np.full(int((length + 2).sum()), ord("<"), dtype=np.uint8)
        low = np.cumsum(length + 2) - length - 2
        inside = np.repeat(low + 1 - np.cumsum(length) + length, length) + np.arange(length.sum())
        guarded[inside] = words.data[np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())]
        guarded[low + length + 1] = ord(">")
        # N-grams are of code points, not of bytes.
        point = np.flatnonzero((guarded & 0xC0) != 0x80)
        owner = np.searchsorted(low, point, side="right") - 1
        after = np.append(point, len(guarded))
        owners, found = [np.arange(len(place))], [mix(one[place] * _SALT[0])]
        for size in SIZES:
            if len(point) >= size:
                at = np.flatnonzero(owner[: len(point) - size + 1] == owner[size - 1 :])
                owners.append(owner[at])
                found.append(mix(hash_spans(guarded, point[at], after[at + size]) * _SALT[1]))
        owners = np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        self.buckets = (np.concatenate(found)[order] >> shift).astype(np.int64)
        self.first = np.searchsorted(owners[order], np.arange(len(place) + 1))
        same = np.flatnonzero(row[:-1] == row[1:])
        left, right = one[same], one[same + 1]
        pair = np.where(left == right, _AGAIN[0], mix(left * _SALT[2] + right * _SALT[3]))
        self.pairs = row[same], (pair >> shift).astype(np.int64)
        self.tokens = np.bincount(row, minlength=self.rows) + np.bincount(row[same], minlength=self.rows)

    def means(self, table: np.ndarray) -> np.ndarray:
        """The mean over each text's tokens of a number per bucket; 0 without tokens."""
        total = np.bincount(self.pairs[0], weights=table[self.pairs[1]], minlength=self.rows)
        if len(self.buckets):
            own = np.add.reduceat(table[self.buckets], self.first[:-1]) / np.diff(self.first)
            total += np.bincount(self.words[0], weights=own[self.words[1]], minlength=self.rows)
        return total / np.maximum(self.tokens, 1)

    def weights(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of one text, ascending, and the share of each in its mean."""
        low, high = np.searchsorted(self.words[0], [row, row + 1])
        token, times = np.unique(self.words[1][low:high], return_counts=True)
        held = self.first[token + 1] - self.first[token]
        at = np.repeat(self.first[token] - np.cumsum(held) + held, held) + np.arange(held.sum())
        low, high = np.searchsorted(self.pairs[0], [row, row + 1])
        bucket = np.concatenate([self.buckets[at], self.pairs[1][low:high]])
        share = np.concatenate([np.repeat(times / held, held), np.ones(high - low)])
        bucket, place = np.unique(bucket, return_inverse=True)
        return bucket, np.bincount(place, weights=share, minlength=len(bucket)) / max(self.tokens[row], 1)


class Learner:
    """Vectors per bucket and a softmax over two classes, moved text by text."""

    def __init__(self, bits: int, size: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.vectors = draw.uniform(-1 / size, 1 / size, (1 << bits, size)).astype(np.float32)
        self.out = np.zeros((2, size), dtype=np.float32)
        self.bias = np.zeros(2, dtype=np.float32)

    def learn(self, bucket: np.ndarray, share: np.ndarray, label: int, rate: float) -> float:
        """One step of gradient descent on a text's log loss, which is returned."""
        mean = share @ self.vectors[bucket]
        level = self.out @ mean + self.bias
        chance = np.exp(level - level.max())
        chance /= chance.sum()
        error = chance.copy()
        error[label] -= 1
        back = error @ self.out
        self.out -= rate * np.outer(error, mean)
        self.bias -= rate * error
        self.vectors[bucket] -= rate * np.outer(share, back)
        return float(-np.log(max(chance[label], 1e-30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, rate: float) -> None:
        """Pass over the rows ``epochs`` times, each in an order of its own, at a falling rate."""
        steps, done = epochs * len(rows), 0
        for epoch in range(epochs):
            for at in np.random.default_rng(epoch).permutation(len(rows)):
                bucket, share, label = rows[at]
                self.learn(bucket, share, label, np.float32(rate * (1 - done / steps)))
                done += 1

    def table(self) -> tuple[np.ndarray, float]:
        """What a text's log odds of class 1 are made of: the mean of a number per bucket, and the rest."""
        table = (self.vectors @ (self.out[1] - self.out[0])).astype(np.float64)
        return table, float(self.bias[1] - self.bias[0])


class QualityModel:
    """One number per bucket and a constant: vectors and softmax multiplied out."""

    def __init__(self, bits: int, table: np.ndarray, constant: float):
        self.bits, self.table, self.constant = bits, table, constant

    def score(self, texts: pa.Array) -> np.ndarray:
        total = Pieces(texts, self.bits).means(self.table) + self.constant
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_on: Column | None = None,
    train_rows: int = 8_192,
    bits: int = BITS,
    size: int = 16,
    epochs: int = 5,
    rate: float = 3.0,
) -> QualityModel:
    """Learn the labels (0 or 1) of the ``train_rows`` labelled rows with the least hash of their id.

    ``train_on`` restricts the rows of ``labels``; rows with a null id or label are left out.
    Executors turn the sample's whole texts into buckets and shares; one task, whose input
    ``train_rows`` bounds, descends over them. The model is ``2 ** bits`` numbers.
    """
    spark = docs.sparkSession
    marked = labels if train_on is None else labels.where(train_on)
    marked = marked.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    order = F.xxhash64(F.col("id"), F.lit("quality"))
    sample = marked.withColumn("order", order).orderBy("order", "id", "label").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("order", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 2):
            pieces = Pieces(part.column(2), bits)
            held = [pieces.weights(i) for i in range(part.num_rows)]
            yield pa.record_batch(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([b.astype("<i4").tobytes() for b, _ in held], pa.binary()),
                    pa.array([s.astype("<f4").tobytes() for _, s in held], pa.binary()),
                ],
                names=["order", "label", "buckets", "shares"],
            )

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for order, label, bucket, share in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((order, label, bucket, share))
        held.sort()
        held = [(np.frombuffer(b, "<i4"), np.frombuffer(s, "<f4"), int(label > 0)) for _, label, b, s in held]
        if held:
            learner = Learner(bits, size)
            learner.fit(held, epochs, rate)
            table, constant = learner.table()
            yield pa.record_batch([pa.array([table.tobytes()], pa.binary()), pa.array([constant])], names=["table", "constant"])

    train = rows.mapInArrow(extract, "order long, label int, buckets binary, shares binary")
    found = train.repartition(1).mapInArrow(descend, "table binary, constant double").first()
    if found is None:
        return QualityModel(bits, np.zeros(1 << bits), 1.0)
    return QualityModel(bits, np.frombuffer(found.table, dtype="<f8"), found.constant)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every document's whole text: how likely class 1 is, from 0 to 1.

    A null or empty text has the score of the constant. Null ids and repeated rows are
    scored like others.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for part in chunks(batches, 1):
            yield pa.record_batch([part.column(0), pa.array(model.score(part.column(1)))], names=["id", "score"])

    return chosen.mapInArrow(run, chosen.select("id").schema.add("score", "double"))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    least: float = 0.3,
    **options,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` per document, learned from rows not held out.

    ``predicted`` is 1 from a score of ``least`` on. Without any labelled document to learn
    from, all scores are the same and above it. Empty tables give an empty result.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col, train_on=~held_out(id_col), **options)
    scored = score_quality(docs, model, id_col, text_col)
    return scored.withColumns({"held_out": held_out("id"), "predicted": (F.col("score") >= least).cast("int")})
