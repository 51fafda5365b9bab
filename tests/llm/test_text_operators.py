"""Quality scores, ranked search and collocations against brute force and on edge rows."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm.collocations import collocations, frequent_phrases
from millrace.llm.minhash import _sign, near_duplicates
from millrace.llm.quality import Learner, Pieces, quality
from millrace.llm.search import search
from millrace.llm.text import chunks
from millrace.llm.toxicity import ToxicityModel, features, fit_toxicity
from millrace.session import written

SF_DIR = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, score string, rank string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_search(docs, items, most=20):
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    some = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    wanted = defaultdict(Counter)
    for item, text in items:
        wanted[item].update(TERM.findall(lower(text)))
    found = []
    for item, terms in wanted.items():
        scored = []
        for doc, own in held:
            score = 0
            for term, times in terms.items():
                if tf := own[term]:
                    df = sum(term in c for _, c in held)
                    weight = math.floor(1000 * math.log((2 * some + 2) / (2 * df + 1)))
                    m = 100 - 25 + (25 * sum(own.values()) * some) // total
                    score += times * weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        found += [
            (item, rank, None if none else doc, -low) for rank, (low, none, doc) in enumerate(sorted(scored)[:most], 1)
        ]
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


ITEMS = [
    (1, "Red fox, red FOX; den"),
    (2, "été 2024 école"),
    (2, "naïve den"),
    (3, None),
    (4, " ,.- "),
    (None, "the red owl"),
    (5, "fo"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_search(spark, block_bytes):
    rng = random.Random(3)
    vocabulary = ["red", "RED", "fox", "fox.", "foxes", "den", "été", "Été", "école", "2024", "the", "owl", "naïve", "fo", "-", "x_y"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(150)]
    docs += [(7, "red fox"), (7, "red fox"), (None, "fox\tden\x00red"), (None, None), (200, ""), (201, "\n\n"), (202, "den " * 30_000)]
    docs += [(300 + i, "owl owl") for i in range(60)]
    frame = spark.createDataFrame([(*d, None, "clash", "clash") for d in docs], DOC).repartition(5)
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, score string")
    found = search(frame, items, most=20, block_bytes=block_bytes)
    assert found.columns == ["item", "rank", "id", "score"]
    assert in_order(tuple(r) for r in found.collect()) == in_order(plain_search(docs, ITEMS))


def test_search_nothing(spark):
    none = spark.createDataFrame([], DOC)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(1, " .", None, None, None)], DOC)
    assert search(none, items).count() == 0
    assert search(docs, items).count() == 0
    assert search(docs, items.limit(0)).count() == 0


def plain_collocations(docs, longest, least, most):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            own = re.findall("[^ \t]+", piece)
            total[lang] += len(own)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(own[i : i + size]) for i in range(len(own) - size + 1))
    found = []
    for lang, held in counts.items():
        often = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        scored = []
        for phrase, a in often.items():
            inside = any(
                b >= a and len(other) > len(phrase)
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other) - len(phrase) + 1))
                for other, b in often.items()
            )
            if inside:
                continue
            score, _, l, r = min(
                (1000 * a * total[lang] // (held[phrase[:k]] * held[phrase[k:]]), k, held[phrase[:k]], held[phrase[k:]])
                for k in range(1, len(phrase))
            )
            scored.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return found


@pytest.mark.parametrize("most", [5, 1000])
def test_collocations(spark, most):
    rng = random.Random(11)
    words = ["a", "b", "C", "dd", "é", "É", "\x00", "|", "lang", "und"]
    docs = []
    for lang in ("en", "und", None, "fr", ""):
        for _ in range(30):
            docs.append((lang, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ",", "\n", ". "]) for _ in range(60))))
    docs += [("en", None), ("en", ""), (None, " \t "), ("en", "x y z w v u " * 20), ("en", "same " * 3_000), ("fr", "b a")]
    docs += docs[:10]
    rows = [(i, text, lang, "clash", "clash") for i, (lang, text) in enumerate(docs)]
    frame = spark.createDataFrame(rows, DOC).repartition(6)
    found = collocations(frame, longest=5, least=12, most=most)
    assert in_order(tuple(r) for r in found.collect()) == in_order(plain_collocations(docs, 5, 12, most))


def test_collocations_nothing(spark):
    none = spark.createDataFrame([], DOC)
    assert collocations(none).count() == 0
    few = spark.createDataFrame([(1, "a b", "en", None, None), (2, None, None, None, None)], DOC)
    assert collocations(few, least=2).count() == 0
    found, words = frequent_phrases(few, longest=2, least=1)
    assert sorted((r.phrase, r.a) for r in found.collect()) == [("a", 1), ("a b", 1), ("b", 1)]
    assert [tuple(r) for r in words.collect()] == [("en", 2)]


def test_pieces_are_means():
    """Weights of a text multiplied out give the same mean as the batch, and repeats have a token of their own."""
    texts = pa.array(["aa bb aa", None, "", "été | été", "x " * 500, "aa"])
    pieces = Pieces(texts, 12)
    table = np.random.default_rng(0).normal(size=1 << 12)
    means = pieces.means(table)
    for row in range(len(texts)):
        bucket, share = pieces.weights(row)
        assert np.isclose(means[row], (table[bucket] * share).sum())
        assert np.isclose(share.sum(), 1.0 if pieces.tokens[row] else 0.0)
    assert list(pieces.tokens) == [5, 0, 0, 5, 999, 1]
    assert Pieces(pa.array([], pa.string()), 12).means(table).shape == (0,)


def test_learner_descends_the_gradient():
    """One step moves vectors and output along the numeric gradient of the log loss."""
    learner = Learner(4, 3)
    learner.out = np.random.default_rng(1).normal(size=(2, 3)).astype(np.float64)
    learner.vectors, learner.bias = learner.vectors.astype(np.float64), learner.bias.astype(np.float64)
    bucket, share = np.array([1, 5, 9]), np.array([0.5, 0.25, 0.25])

    def loss(vectors, out):
        level = out @ (share @ vectors[bucket])
        return np.log(np.exp(level).sum()) - level[1]

    vectors, out = learner.vectors.copy(), learner.out.copy()
    learner.learn(bucket, share, 1, 1e-3)
    for name, before, after in (("vectors", vectors, learner.vectors), ("out", out, learner.out)):
        for at in [(5, 1), (1, 0)] if name == "vectors" else [(0, 2), (1, 1)]:
            moved = before.copy()
            moved[at] += 1e-6
            slope = (loss(moved, out) if name == "vectors" else loss(vectors, moved)) - loss(vectors, out)
            assert np.isclose((before[at] - after[at]) / 1e-3, slope / 1e-6, atol=1e-4)


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    told = [(r.predicted, truth[r.id]) for r in rows if r.held_out and r.id in truth]
    assert sum(p == t for p, t in told) >= 0.97 * len(told)
    assert sum(p == 0 for p, t in told if t == 0) >= 0.9 * sum(t == 0 for _, t in told)
    # What is held out is not learned from.
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted((r.id, r.score) for r in quality(docs, other).collect()) == sorted((r.id, r.score) for r in rows)


def test_quality_edge(spark):
    rows = [(i, "good plain words here", "en", None, None) for i in range(40)]
    rows += [(100 + i, "bad!! bad!! bad!!", None, "x", None) for i in range(40)]
    rows += [(None, "bad!!", None, None, None), (7, None, None, None, None), (8, "", None, None, None), (9, "w " * 50_000, None, None, None)]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, DOC)
    labels = [(i, int(i < 100), "clash") for i in [*range(40), *range(100, 140)]] + [(None, 1, "x"), (0, None, "x"), (1, 1, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    found = quality(docs, labels, rate=20.0).collect()
    assert len(found) == len(rows)
    assert all(r.predicted == 1 for r in found if r.id is not None and 10 < r.id < 40)
    assert all(r.predicted == 0 for r in found if r.id is not None and r.id >= 100)
    unlearned = quality(docs, labels.limit(0)).collect()
    assert {(round(r.score, 6), r.predicted) for r in unlearned} == {(round(1 / (1 + math.exp(-1)), 6), 1)}
    assert quality(docs.limit(0), labels).count() == 0


def plain_ftrl(rows, epochs, bits, alpha=1.0, beta=1.0, l1=4.0, l2=0.5):
    """One learner over all rows, coordinate by coordinate; the intercept has no penalty."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if i == "bias":
            return -z[i] * alpha / (beta + math.sqrt(n[i]))
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for own, label in rows:
            weights = {i: weight(i) for i in [*own, "bias"]}
            gradient = 1 / (1 + math.exp(-sum(weights.values()))) - label
            for i, w in weights.items():
                step = (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / alpha
                z[i] += gradient - step * w
                n[i] += gradient**2
    return {i: weight(i) for i in z}


def test_ftrl_is_the_sequential_one(spark):
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(0, 30)))) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int("aa" in t.split() or "bbb" in t)) for i, t in texts], "doc_id long, toxic int")
    order = labels.select("doc_id", "toxic", F.xxhash64("doc_id", F.lit("train")).alias("o")).orderBy("o").collect()
    held = dict(texts)
    rows = [(features(pa.array([held[r.doc_id]]), 14)[0].tolist(), r.toxic) for r in order]
    expected = plain_ftrl(rows, 3, 14)
    model = fit_toxicity(docs, labels, epochs=3, bits=14)
    assert math.isclose(model.intercept, expected.pop("bias"), rel_tol=1e-9)
    assert {i for i, w in expected.items() if w} == set(model.numbers.tolist())
    assert all(math.isclose(w, expected[i], rel_tol=1e-9) for i, w in zip(model.numbers.tolist(), model.weights))
    assert fit_toxicity(docs, labels.limit(0), bits=14).intercept == -1.0


@pytest.mark.parametrize("size", [200, 400])
def test_graded_copies_leave_no_square_of_rows(spark, size, monkeypatch):
    """Copies that share bands without being linked: all links are found, and no rejected pair becomes a row."""
    rng = random.Random(size)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(size):
        own = list(base)
        for at in rng.sample(range(120), rng.choice([6, 10, 12, 14])):
            own[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    made = {}

    def counted(df, label, **options):
        out = written(df, label, **options)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr("millrace.llm.minhash.written", counted)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=1).collect()
    sets = {i: set(t.split()) for i, t in rows}
    parent = {i: i for i in sets}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id: r.component_id for r in found} == {i: top(i) for i in sets}
    assert made["edges"] <= 32 * size


def test_a_worker_holds_little_of_a_batch():
    draw = random.Random(5)
    texts = [" ".join(str(draw.randrange(5000)) for _ in range(400)) for _ in range(1500)]
    batch = pa.record_batch([pa.array(range(1500)), pa.array(range(1500)), pa.array(texts)], names=["a", "b", "c"])
    score = ToxicityModel(20, np.arange(1000), np.ones(1000), 0.0).scorer()
    score(batch.column(2).slice(0, 1))
    peaks = []
    tracemalloc.start()
    for run in (lambda: _sign(5, 256)(iter([batch])), lambda: map(lambda part: score(part.column(2)), chunks([batch], 2))):
        tracemalloc.reset_peak()
        for _ in run():
            pass
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
    tracemalloc.stop()
    assert peaks[0] < 16 and peaks[1] < 24
