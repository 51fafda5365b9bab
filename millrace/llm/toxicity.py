"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import chunks, hash_spans, mix, randoms, split_words
from millrace.session import SMALL_BATCHES, session_conf

BITS = 20
STEM_BYTES = (4, 6)
_U = np.uint64
# Words of letters and digits: everything beyond ASCII counts as a letter.
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[128:] = True
_LETTERS[ord("a") : ord("z") + 1] = True
_LETTERS[ord("0") : ord("9") + 1] = True


def occurrences(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every feature of the texts, as often as it occurs.

    Features are words (lower-cased A-Z, without signs), pairs of neighbours, pairs with
    one word between them, and the first bytes (``STEM_BYTES``) of longer words, for
    languages that compound.
    """
    words = split_words(texts, lower=True, letters=_LETTERS)
    row, one = words.row, words.hash
    salts = randoms(31, 4 + len(STEM_BYTES)) | _U(1)
    parts = [(row, one)]
    for gap in (1, 2):
        if len(one) > gap:
            pair = mix(one[:-gap] * salts[gap] + one[gap:] * salts[gap + 1])
            same = row[:-gap] == row[gap:]
            parts.append((row[:-gap][same], pair[same]))
    for salt, size in zip(salts[4:], STEM_BYTES):
        long = np.flatnonzero(words.end - words.start > size)
        stem = hash_spans(words.data, words.start[long], words.start[long] + size)
        parts.append((row[long], mix(stem * salt)))
    numbers = np.concatenate([h for _, h in parts]) >> _U(64 - bits)
    return np.concatenate([r for r, _ in parts]), numbers.astype(np.int64)


def _distinct(rows: np.ndarray, numbers: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((rows << bits) | numbers)
    return both >> bits, both & ((1 << bits) - 1)


def features(texts: pa.Array, bits: int = BITS) -> list[np.ndarray]:
    """The distinct feature numbers of each text, ascending."""
    rows, numbers = _distinct(*occurrences(texts, bits), bits)
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    return [numbers[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


class Ftrl:
    """Per-coordinate FTRL-proximal state: ``z`` and ``n`` per feature, and for the intercept."""

    def __init__(self, bits: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        # The intercept follows the features.
        self.bias = 1 << bits
        self.z, self.n = np.zeros(self.bias + 1), np.zeros(self.bias + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        size = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, size)

    def intercept(self) -> float:
        z, n = self.z[self.bias], self.n[self.bias]
        return float(-z * self.alpha / (self.beta + np.sqrt(n)))

    def learn(self, at: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(weights.sum() + self.intercept(), -35, 35))) - label
        for i, w in ((at, weights), (self.bias, self.intercept())):
            step = (np.sqrt(self.n[i] + gradient * gradient) - np.sqrt(self.n[i])) / self.alpha
            self.z[i] += gradient - step * w
            self.n[i] += gradient * gradient


class ToxicityModel:
    """The non-zero weights and the intercept, which is all that scoring needs."""

    def __init__(self, bits: int, numbers: np.ndarray, weights: np.ndarray, intercept: float):
        self.bits, self.numbers, self.weights, self.intercept = bits, numbers, weights, intercept

    def scorer(self):
        """A function from texts to scores. Features without a weight are dropped before
        the rest are made distinct, so most of a text costs one look-up."""
        table = np.zeros(1 << self.bits)
        table[self.numbers] = self.weights
        weighs = table != 0

        def score(texts: pa.Array) -> np.ndarray:
            rows, numbers = occurrences(texts, self.bits)
            met = weighs[numbers]
            rows, numbers = _distinct(rows[met], numbers[met], self.bits)
            total = np.bincount(rows, weights=table[numbers], minlength=len(texts)) + self.intercept
            return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

        return score


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_on: Column | None = None,
    train_rows: int = 20_000,
    epochs: int = 8,
    bits: int = BITS,
) -> ToxicityModel:
    """Learn the labels (0 or 1) of the ``train_rows`` labelled rows with the least hash of their id.

    ``train_on`` restricts the rows of ``labels``. Rows with a null id or label are left
    out. Executors turn the sample's whole texts into feature numbers; one task, whose input
    ``train_rows`` bounds, learns them ``epochs`` times, one after another in the order of
    the hash, and hands on the non-zero weights alone, ``2 ** bits`` at most.
    """
    marked = labels if train_on is None else labels.where(train_on)
    marked = marked.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    order = F.xxhash64(F.col("id"), F.lit("train"))
    sample = marked.withColumn("order", order).orderBy("order", "id", "label").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("order", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 2):
            found = features(part.column(2), bits)
            yield pa.record_batch(
                [part.column(0), part.column(1), pa.array([f.astype("<i4").tobytes() for f in found], pa.binary())],
                names=["order", "label", "features"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        if not rows:
            return
        rows.sort()
        own = Ftrl(bits)
        for _ in range(epochs):
            for _, label, data in rows:
                own.learn(np.frombuffer(data, dtype="<i4"), int(label > 0))
        numbers = np.flatnonzero(np.abs(own.z[: 1 << bits]) > own.l1)
        weights = own.weights(numbers)
        yield pa.record_batch(
            [
                pa.array([numbers.astype("<i8").tobytes()], pa.binary()),
                pa.array([weights.astype("<f8").tobytes()], pa.binary()),
                pa.array([own.intercept()]),
            ],
            names=["numbers", "weights", "intercept"],
        )

    train = rows.mapInArrow(extract, "order long, label int, features binary")
    with session_conf(docs.sparkSession, SMALL_BATCHES):
        found = train.repartition(1).mapInArrow(learn, "numbers binary, weights binary, intercept double").first()
    if found is None:
        return ToxicityModel(bits, np.empty(0, np.int64), np.empty(0), -1.0)
    numbers, weights = np.frombuffer(found.numbers, dtype="<i8"), np.frombuffer(found.weights, dtype="<f8")
    return ToxicityModel(bits, numbers, weights, found.intercept)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", keep: bool = False
) -> DataFrame:
    """``(id, score)`` of every document's whole text, from 0 to 1; with ``keep`` the whole row
    (``doc``) in place of the id.

    A null or empty text has the score of the intercept. Null ids and repeated rows are
    scored like others.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(F.struct("*").alias("doc")) if keep else docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )

    name, place = chosen.columns[0], docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held.value.scorer()
        for batch in batches:
            texts = pc.struct_field(batch.column(0), [place]) if keep else batch.column(1)
            parts = chunks([pa.record_batch([texts], names=["text"])], 0)
            score = np.concatenate([np.empty(0), *(scorer(part.column(0)) for part in parts)])
            yield pa.record_batch([batch.column(0), pa.array(score, pa.float64())], names=[name, "score"])

    schema = chosen.select(name).schema.add("score", "double")
    return chosen.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether an id is kept from training: CRC-32 of its text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    **options,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` per document, learned from rows not held out.

    Without any labelled document to learn from, all scores are the same and below 0.5.
    Empty tables give an empty result.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, label_col, train_on=~held_out(id_col), **options)
    scored = score_toxicity(docs, model, id_col, text_col)
    return scored.withColumns({"held_out": held_out("id"), "predicted": (F.col("score") >= 0.5).cast("int")})


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options
) -> DataFrame:
    """The documents, with all their columns, whose score (see ``toxicity``) is below 0.5."""
    model = fit_toxicity(docs, labels, id_col, text_col, label_col, train_on=~held_out(id_col), **options)
    return score_toxicity(docs, model, id_col, text_col, keep=True).where("score < 0.5").select("doc.*")
