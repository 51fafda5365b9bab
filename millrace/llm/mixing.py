"""Mixing documents of soft domains to target weights."""

from __future__ import annotations

import logging
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import written

BUCKETS, MISFIT = 4096, 1e-3
GRID = (2.0, 4.0, 8.0, 16.0, 32.0, 64.0)

log = logging.getLogger(__name__)


def _split(docs: DataFrame, text: str, *kept: str) -> DataFrame:
    """``kept``, the ``words`` of a text and their ``shapes``: letter and digit runs are one letter each."""
    whole = F.coalesce(F.col(text), F.lit(""))
    shape = whole
    for pattern, letter in ((r"\p{Ll}+", "a"), (r"\p{Lu}+", "A"), (r"\p{Nd}+", "0")):
        shape = F.regexp_replace(shape, pattern, letter)
    words = [F.regexp_extract_all(x, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)) for x in (whole, shape)]
    return docs.select(*kept, words[0].alias("words"), words[1].alias("shapes"))


def _word_buckets(buckets: int) -> Column:
    """Hash buckets of the shapes of a text's words.

    A word that repeats the one before it is in the last bucket, whatever the word, so
    repetition is seen though words are not. ``words`` and ``shapes`` are columns, or
    they would be evaluated once per word.
    """

    def bucket(shape: Column, at: Column) -> Column:
        again = (at > 0) & (F.get("words", at) == F.get("words", at - 1))
        return F.when(again, F.lit(buckets - 1)).otherwise(F.pmod(F.xxhash64(shape), F.lit(buckets - 1)).cast("int"))

    return F.transform("shapes", bucket)


class DomainModel:
    """Naive Bayes over hashed word shapes and repetition: ``domains``, log priors, log probabilities.

    Its size is given by the number of domains and buckets, not by the documents.
    """

    def __init__(self, domains: list[str], prior: np.ndarray, log_p: np.ndarray, sharpness: float):
        self.domains, self.prior, self.log_p, self.sharpness = domains, prior, log_p, sharpness

    def posteriors(self, buckets: str) -> Column:
        """An array with the probability of each domain; words count by their mean, so that
        long texts stay as soft as short ones."""
        size = F.greatest(F.size(buckets), F.lit(1))
        scores = []
        for prior, row in zip(self.prior, self.log_p):
            table = F.split(F.lit(",".join(f"{x:.9g}" for x in row)), ",").cast("array<double>")
            total = F.aggregate(buckets, F.lit(0.0), lambda s, b: s + F.get(table, b))
            scores.append(F.lit(float(prior)) + F.lit(self.sharpness) * total / size)
        return F.array(*scores)


def _fit(sums: list, domains: list[str], buckets: int, sharpness: float) -> DomainModel:
    """The model of some sums ``(label, bucket, s)``; no bucket stands for texts without words."""
    mass = np.zeros((len(domains), buckets))
    prior = np.full(len(domains), 1e-9)
    for r in sorted(sums, key=lambda r: (r.label, -1 if r.bucket is None else r.bucket, r.held)):
        prior[domains.index(r.label)] += r.s
        if r.bucket is not None:
            mass[domains.index(r.label), r.bucket] += r.s
    smooth = mass + 0.01
    log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    # A word says how much more likely each domain is than the average one.
    log_p -= log_p.mean(axis=0)
    return DomainModel(domains, np.log(prior / prior.sum()), log_p, sharpness)


def _calibrated(held: DataFrame, model: DomainModel, grid: tuple[float, ...]) -> float:
    """The sharpness with the least mean log loss over held-out rows; the model's own without any."""
    count = len(model.domains)
    label = F.array_position(F.array(*map(F.lit, model.domains)), F.col("label")).cast("int") - 1
    losses = []
    for k, sharpness in enumerate(grid):
        scores = DomainModel(model.domains, model.prior, model.log_p, sharpness).posteriors("buckets")
        held = held.withColumn(f"scores{k}", scores)
        chance = F.get(_normalised(f"scores{k}", count), label)
        losses.append(F.avg(-F.log(F.greatest(chance, F.lit(1e-12)))))
    row = held.agg(*losses).first()
    return model.sharpness if row[0] is None else grid[int(np.argmin(row))]


def fit_domains(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = 20_000,
    buckets: int = BUCKETS,
    sharpness: float | None = None,
) -> DomainModel:
    """A classifier of the labelled documents.

    It is fitted on the ``train_rows`` labelled rows with the least hash of their id. Rows
    without id or label are left out, as are words of documents that are not in ``docs``.
    Each document has the same weight however long. ``sharpness``, how far a mean word
    moves the odds, is the one of ``GRID`` that suits the fifth of these rows best that
    a trial fit on the others leaves out. Without any labelled document there is one
    domain, ``unknown``.
    """
    label = F.col(label_col).cast("string")
    marked = labels.select(F.col(id_col).alias("id"), label.alias("label")).dropna().distinct()
    sample = marked.orderBy(F.xxhash64("id"), "id", "label").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    held = F.pmod(F.xxhash64("id", F.lit("held")), F.lit(5)) == 0
    known = _split(texts.withColumn("held", held), "text", "label", "held")
    known = written(known.select("label", "held", _word_buckets(buckets).alias("buckets")), "known")
    words = known.select("label", "held", F.size("buckets").alias("size"), F.explode_outer("buckets").alias("bucket"))
    share = F.sum(F.lit(1.0) / F.greatest("size", F.lit(1)))
    sums = words.groupBy("label", "bucket", "held").agg(share.alias("s")).collect()
    if not sums:
        return DomainModel(["unknown"], np.zeros(1), np.zeros((1, buckets)), 1.0)
    domains = sorted({r.label for r in sums})
    if sharpness is None:
        trial = _fit([r for r in sums if not r.held], domains, buckets, 10.0)
        sharpness = _calibrated(known.where("held"), trial, GRID)
    return _fit(sums, domains, buckets, sharpness)


def _normalised(scores: str, count: int) -> Column:
    top = F.array_max(scores)
    parts = [F.exp(F.get(scores, F.lit(k)) - top) for k in range(count)]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.array(*[part / total for part in parts])


def _rate(share: str, steps: list[np.ndarray]) -> Column:
    """Rates after some projected steps, from 1 on: each step is one number per domain."""
    rate = F.lit(1.0)
    for step in steps:
        move = F.lit(0.0)
        for k, value in enumerate(step):
            move = move + F.get(share, F.lit(k)) * F.lit(float(value))
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


def fit_rates(
    scored: DataFrame,
    domains: list[str],
    targets: Mapping[str, float],
    budget: float | None = None,
    tolerance: float = 1e-4,
    max_steps: int = 40,
) -> tuple[list[np.ndarray], list[float]]:
    """Projected-gradient least squares; the steps taken and the relative misfit after each.

    ``scored`` has ``tokens`` and ``share`` (an array of posteriors). Sought are rates
    ``r >= 0`` per document, starting at 1, whose expected totals
    ``sum(r * tokens * share[k])`` match ``targets[k] / sum(targets) * budget``. Documents
    are weighted by their tokens, so a rate depends on a document's shares alone, and the
    residuals by the inverse of the domains' Gram matrix. A step is scaled by the Gram
    matrix of the documents whose rate is not zero, for which a length of one is right
    until more rates reach zero; a step that does not bring the totals closer is
    quartered. An evaluation is one aggregate over the documents, of which some numbers
    per pair of domains reach the driver. It ends within ``tolerance`` of the budget, or
    after ``max_steps`` evaluations.
    """
    count = len(domains)
    share = [F.get("share", F.lit(k)) for k in range(count)]
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    first = scored.agg(
        F.sum("tokens").alias("tokens"), *[F.sum(F.col("tokens") * share[a] * share[b]) for a, b in pairs]
    ).first()
    if not first[0]:
        return [], []
    budget = float(first[0]) if budget is None else float(budget)
    gram = np.zeros((count, count))
    for (a, b), value in zip(pairs, first[1:]):
        gram[a, b] = gram[b, a] = value / float(first[0])
    ridge = 1e-6 * np.eye(count)
    inverse = np.linalg.pinv(gram + ridge)
    wanted = np.array([float(targets.get(name, 0.0)) for name in domains])
    if wanted.sum() <= 0 or (wanted < 0).any():
        raise ValueError("targets must be non-negative and name a domain that occurs")
    wanted = wanted / wanted.sum() * budget
    steps: list[np.ndarray] = []
    misfit: list[float] = []
    least = np.inf
    for _ in range(max_steps + 1):
        read = scored.select("tokens", "share", _rate("share", steps).alias("rate"))
        held = F.when(F.col("rate") > 0, F.col("tokens"))
        row = read.agg(
            *[F.sum(F.col("tokens") * F.col("rate") * one) for one in share],
            *[F.sum(held * share[a] * share[b]) for a, b in pairs],
        ).first()
        row = np.array([float(x or 0.0) for x in row]) / float(first[0])
        error = row[:count] - wanted / float(first[0])
        distance = float(error @ inverse @ error)
        if distance < least * (1 - 1e-3):
            least = distance
            misfit.append(float(np.abs(error).max() * float(first[0]) / budget))
            if misfit[-1] <= tolerance:
                return steps, misfit
            for (a, b), value in zip(pairs, row[count:]):
                gram[a, b] = gram[b, a] = value
            steps.append(np.round(np.linalg.pinv(gram + ridge) @ error, 9))
        else:
            steps[-1] = np.round(steps[-1] / 4, 9)
            if np.abs(steps[-1]).max() < 1e-6:
                break
    # The last step was not found to bring the totals closer.
    return steps[:-1], misfit


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float],
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: float | None = None,
    train_rows: int = 20_000,
    keep: bool = False,
) -> DataFrame:
    """``(doc, id, tokens, share, rate, copies)`` per document; ``doc`` is the whole row if ``keep``.

    Domains are the labels of ``labels``; every document belongs to each with the
    posterior that a classifier fitted on the labelled ones gives. ``tokens`` counts
    words. ``rate`` is the fitted number of times the document is to be read, and
    ``copies`` a whole number of times: the rate rounded up with the probability of its
    fraction, decided by a hash of the row, so that totals match and reruns agree.

    An empty or null text has no tokens; its shares are the classifier's priors. Targets
    out of reach (a domain without tokens) are met as nearly as least squares allow; a
    distance of more than ``MISFIT`` of the budget is logged. Null ids and repeated rows are
    treated like other rows. Documents may have any further columns. An empty table gives an empty result.
    """
    model = fit_domains(docs, labels, label_col, id_col, text_col, train_rows)
    whole = [F.struct("*").alias("doc")] if keep else []
    texts = docs.select(
        *whole,
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("draw"),
        F.col(text_col).alias("text"),
    )
    kept = [c for c in texts.columns if c != "text"]
    words = _split(texts, "text", *kept).select(*kept, _word_buckets(model.log_p.shape[1]).alias("buckets"))
    scores = words.select(*kept, F.size("buckets").cast("long").alias("tokens"), model.posteriors("buckets").alias("scores"))
    scored = written(
        scores.select(*kept, "tokens", _normalised("scores", len(model.domains)).alias("share")), "scored"
    )
    steps, misfit = fit_rates(scored, model.domains, targets, budget)
    if misfit and misfit[-1] > MISFIT:
        log.warning("expected totals miss their targets by up to %.4f of the budget", misfit[-1])
    rated = scored.withColumn("rate", _rate("share", steps))
    unit = F.pmod("draw", F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = (F.floor("rate") + (unit < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    return rated.withColumn("copies", copies).drop("draw")


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], label_col: str, **options) -> DataFrame:
    """The documents, each as often as ``mixing_rates`` says, with all their columns."""
    rated = mixing_rates(docs, labels, targets, label_col, keep=True, **options)
    repeated = rated.where("copies > 0").select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return repeated.select("doc.*")
