"""Mixing to target weights with soft membership.

A classifier trained on a labelled table gives each document posteriors over domains. A
document's tokens count towards every domain by its posterior, and rates r >= 0 are fitted so
that the expected domain totals  T_c = sum_d r_d * tokens_d * p_dc  meet targets G_c: projected
gradient on  sum_c (T_c - G_c)**2 / M_c + PULL * sum_d tokens_d * (r_d - 1)**2,  where M_c are
the totals at rate 1.

A document's gradient is a combination of its posteriors, the same for equal posteriors, so
every iterate is a projection  r_d = max(0, 1 - m . p_d)  with one multiplier per domain; rates
aren't stored between rounds. A round is one distributed pass that sums, over documents with
rates above zero, the totals and their curvature (one number for each pair of domains). The
gradient step is scaled by that curvature and halved while it does not lessen the dual
objective. Rounds end when the gradient vanishes, not before, unless rounding keeps it from that.
Targets that no rates can meet (a domain at zero whose trace is in every document) end at the
least squares; ``Fit.errors`` tells what is left.

The classifier is a multinomial logistic regression over hashed words (2**HASH_BITS, present
or not, and the bytes that end them; those that tell domains apart), fitted on a bounded sample: the first TRAIN_DOCS labelled documents of
each domain in hash order. Tokens are words.

Cases: a null or empty text has no tokens, the posteriors of an empty text and the rate they
give. Texts of any length are read whole. Repeated documents get the same posteriors and rates.
Labels of unknown documents or null labels are left out; repeated labels count once; of
contradictory ones the last domain by name counts. Of domains with equal posteriors each is the
likeliest. With no or one labelled domain every posterior is uniform over the domains found. An empty table
gives no rows. Columns named like a result column are replaced.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import map_texts, raw, word_hashes, words
from marlstone.storage import materialize

HASH_BITS = 16
#: Labelled documents of each domain that the classifier is fitted on at most.
TRAIN_DOCS = 1500
CHANCE = 4.0  # standard deviations that say nothing yet
PULL = 1e-5  # weight of staying at rate 1, against squared relative errors
MISSED = 1e-3  # relative error that is warned of
FLAT = 1e-9  # gradient, relative to the targets' scale, that counts as none

# The domains of a label row.
DOMAINS = ["clean", "junk", "toxic"]


def domain_of(labels: DataFrame, quality: str = "quality", toxic: str = "toxic") -> F.Column:
    """The domain of a label row: toxic, else junk or clean by quality."""
    return F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 0, "junk").when(F.col(quality) == 1, "clean")


def _counts(part: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every word for the classifier, each text's first of those (n + 1), and each text's number of words."""
    data, offsets = raw(part)
    _, _, first = words(data, offsets)
    # Case, full stops and commas carry little: letters are folded, the marks part words.
    folded = data.copy()
    folded[(folded >= 65) & (folded <= 90)] += 32
    folded[(folded == 44) | (folded == 46)] = 32
    start, end, own = words(folded, offsets)
    top = 1 << HASH_BITS
    bucket = (word_hashes(folded, start, end) % np.uint64(top - 256)).astype(np.int64)
    last = top - 256 + folded[end - 1].astype(np.int64)  # the byte that ends a word has buckets of its own
    return np.stack([bucket, last], axis=1).ravel(), 2 * own, np.diff(first).astype(np.int64)


def vectors(part: pa.Array) -> list[np.ndarray]:
    """Of each text the buckets of its words."""
    bucket, first, _ = _counts(part)
    return [np.unique(bucket[a:b]) for a, b in zip(first[:-1], first[1:])]


class Classifier:
    """Logistic regression over hashed words that tell domains apart."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: np.ndarray) -> None:
        self.names, self.weights, self.bias = names, weights, bias

    @staticmethod
    def train(rows: list[np.ndarray], y: np.ndarray, names: list[str], sizes: list[int] | None = None, rounds: int = 200) -> Classifier:
        """``sizes``: how many labelled documents each domain has in all, if the rows are a part of them."""
        c, width = len(names), 1 << HASH_BITS
        w, b = np.zeros((width, c)), np.zeros(c)
        if len(set(y.tolist())) < 2:
            return Classifier(names, w, b)
        index, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        # A word counts by how far its documents in a domain exceed what chance would give, in standard deviations.
        share = np.bincount(y, minlength=c)
        has = np.stack([np.bincount(index[y[owner] == k], minlength=width) for k in range(c)], axis=1)
        expected = has.sum(axis=1, keepdims=True) * share / share.sum()
        excess = ((has - expected) / np.sqrt(expected + 1)).max(axis=1)
        weigh = np.where(excess > CHANCE, np.minimum(excess / 10, 2), 0)
        told = weigh[index] > 0
        index, owner = index[told], owner[told]
        value = weigh[index]
        each = (np.asarray(sizes if sizes is not None else share) / np.maximum(share, 1))[y]
        each = each / each.sum()
        truth = np.eye(c)[y]
        first, second = np.zeros_like(w), np.zeros_like(w)
        b1, b2 = np.zeros(c), np.zeros(c)
        for step in range(1, rounds + 1):
            z = np.stack([np.bincount(owner, value * w[index, k], minlength=len(rows)) for k in range(c)], axis=1) + b
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            d = (p - truth) * each[:, None]
            g = np.stack([np.bincount(index, value * d[owner, k], minlength=width) for k in range(c)], axis=1) + 1e-6 * w
            gb = d.sum(axis=0)
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            b1, b2 = 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
            w = w - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
            b = b - 0.05 * (b1 / (1 - 0.9**step)) / (np.sqrt(b2 / (1 - 0.999**step)) + 1e-9)
        return Classifier(names, (w * weigh[:, None]).astype(np.float32), b)

    def posteriors(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and posteriors of each text."""
        bucket, first, n_words = _counts(part)
        n = len(first) - 1
        pair = np.unique((np.repeat(np.arange(n), np.diff(first)) << HASH_BITS) | bucket)
        owner, bucket = pair >> HASH_BITS, pair & ((1 << HASH_BITS) - 1)
        z = np.stack([np.bincount(owner, self.weights[bucket, k], minlength=n) for k in range(len(self.names))], axis=1) + self.bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return n_words, p / p.sum(axis=1, keepdims=True)


def train(docs: DataFrame, labels: DataFrame, domain: F.Column, names: list[str], doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """A classifier from the first TRAIN_DOCS labelled documents of each domain in hash order."""
    known = labels.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), domain.alias("domain")).where(F.col("doc_id").isNotNull() & F.col("domain").isin(names)).groupBy("doc_id").agg(F.max("domain").alias("domain"))
    counts = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    parts = [known.where(F.col("domain") == n).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS) for n in names]
    picked = reduce(DataFrame.union, parts).select("doc_id", "domain")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(picked), "doc_id").select("doc_id", "domain", "text")

    def work() -> Callable[[pa.RecordBatch], dict[str, Any]]:
        def one(part: pa.RecordBatch) -> dict[str, Any]:
            found = vectors(part.column(part.schema.get_field_index("text")))
            return {"at": pa.array([a.astype(np.int32).tobytes() for a in found], pa.binary())}

        return one

    found = map_texts(rows, "text", [T.StructField("at", T.BinaryType())], work, without=("text",)).select("doc_id", "domain", "at")
    got = sorted(found.collect(), key=lambda r: (r.doc_id, bytes(r.at)))
    return Classifier.train([np.frombuffer(r.at, np.int32).astype(np.int64) for r in got], np.array([names.index(r.domain) for r in got], np.int64), names, [counts.get(n, 0) for n in names])


def with_posteriors(docs: DataFrame, model: Classifier, text: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with n_tokens and one column p_<domain> for each domain, but not ``without``."""
    fields = [T.StructField("n_tokens", T.LongType())] + [T.StructField(f"p_{n}", T.DoubleType()) for n in model.names]

    def work() -> Callable[[pa.RecordBatch], dict[str, Any]]:
        def one(part: pa.RecordBatch) -> dict[str, Any]:
            n, p = model.posteriors(part.column(part.schema.get_field_index(text)))
            return {"n_tokens": pa.array(n)} | {f"p_{x}": pa.array(p[:, i]) for i, x in enumerate(model.names)}

        return one

    return map_texts(docs, text, fields, work, without=without)


class Fit(NamedTuple):
    """Multipliers by domain, what is left of (T_c - G_c) / M_c, and the passes taken."""

    multipliers: list[float]
    errors: dict[str, float]
    passes: int


def _named(names: list[str]) -> list[F.Column]:
    return [F.col(f"p_{n}") for n in names]


def rate_of(names: list[str], multipliers: list[float]) -> F.Column:
    """max(0, 1 - m . p)."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.lit(float(m)) * p for m, p in zip(multipliers, _named(names))), F.lit(0.0)))


def fit_rates(rows: DataFrame, targets: dict[str, float], names: list[str]) -> Fit:
    """Multipliers whose rates bring the totals of ``rows`` (n_tokens, p_<domain>) to ``targets``, or as near as rates can.

    At the least squares  PULL * m_c = (T_c - G_c) / M_c;  that difference is the gradient, in the
    metric that weighs a document by its tokens, of the convex dual
    sum_c (PULL * M_c * m_c**2 / 2 + G_c * m_c) + sum_d tokens_d * r_d**2 / 2.
    """
    p, n = _named(names), F.col("n_tokens")
    size = len(names)
    goal = np.array([float(targets.get(x, 0.0)) for x in names])
    passes = 0

    def sums(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        nonlocal passes
        passes += 1
        r = F.col("_rate")
        live = F.when(r > 0, n).otherwise(0)
        cells = [F.sum(live * p[i] * p[j]).alias(f"h{i}_{j}") for i in range(size) for j in range(i, size)]
        got = rows.withColumn("_rate", rate_of(names, m.tolist())).agg(*[F.sum(r * n * p[i]).alias(f"t{i}") for i in range(size)], F.sum(n * r * r).alias("square"), *cells).first()
        total = np.array([float(got[f"t{i}"] or 0.0) for i in range(size)])
        curve = np.array([[float(got[f"h{min(i, j)}_{max(i, j)}"] or 0.0) for j in range(size)] for i in range(size)])
        return total, curve, float(got["square"] or 0.0)

    m = np.zeros(size)
    total, curve, square = sums(m)
    whole = total.copy()
    real = whole > 0
    errors = {x: 0.0 for x in names}
    if not real.any():
        return Fit(m.tolist(), errors, passes)
    scale = np.where(real, whole, 1.0)

    def dual(m: np.ndarray, square: float) -> float:
        return float((PULL * scale * m * m / 2 + goal * m)[real].sum() + square / 2)

    while True:
        slope = np.where(real, PULL * scale * m + goal - total, 0.0)
        if np.abs(slope / scale).max() <= FLAT:
            break
        bend = np.diag(PULL * scale) + np.where(real[:, None] & real[None, :], curve, 0.0)
        step, now, length = np.linalg.solve(bend, -slope), dual(m, square), 1.0
        while length > 1e-6:
            total_, curve_, square_ = sums(m + length * step)
            if dual(m + length * step, square_) < now + 1e-4 * length * float(slope @ step):
                break
            length /= 2
        else:
            break
        m, total, curve, square = m + length * step, total_, curve_, square_
    return Fit(m.tolist(), {x: float(e) for x, e in zip(names, np.where(real, (total - goal) / scale, 0.0))}, passes)


def copies(rate: F.Column, *row: F.Column) -> F.Column:
    """Whole copies of a row: floor(rate), and one more if a hash of the row is below the fraction, so that the expected number is the rate."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit("copies"), *row), 11) / F.lit(float(1 << 53))
    return (F.floor(rate) + F.when(place < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def fit_mix(docs: DataFrame, model: Classifier, shares: dict[str, float], budget: float = 1.0, text: str = "text", keep: list[str] | None = None, without: tuple[str, ...] = ()) -> tuple[DataFrame, Fit]:
    """Columns ``keep`` of ``docs`` with n_tokens, posteriors and rate, and the fit.

    ``shares``: by domain the target as a multiple of the tokens it has now; ``budget`` scales
    them all. Domains without a share are to lose their tokens. Documents whose likeliest domain
    is in ``without`` get rate 0 and are left out of what a domain has; the trace of such a
    domain in all other documents is mixed like any other.
    """
    names = model.names
    found = with_posteriors(docs, model, text, without=() if keep is None or text in keep else (text,))
    kept = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in {"n_tokens", "rate", *(f"p_{n}" for n in names)}]
    rows = materialize(found.select(*kept, "n_tokens", *[f"p_{n}" for n in names]), "mixing")
    best = F.greatest(*_named(names)) if len(names) > 1 else F.lit(1.0)
    barred = F.lit(False)
    for n in without:
        barred = barred | (F.col(f"p_{n}") == best)
    stay = rows.where(~barred).select("n_tokens", *[f"p_{n}" for n in names])
    have = stay.agg(*[F.sum(F.col("n_tokens") * F.col(f"p_{n}")).alias(n) for n in names]).first()
    fit = fit_rates(stay, {n: budget * shares.get(n, 0.0) * float(have[n] or 0.0) for n in names}, names)
    return rows.withColumn("rate", F.when(barred, 0.0).otherwise(rate_of(names, fit.multipliers))), fit


def mix(docs: DataFrame, model: Classifier, shares: dict[str, float], budget: float = 1.0, text: str = "text", keep: list[str] | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``fit_mix``; targets that are missed by more than MISSED are warned of."""
    rows, fit = fit_mix(docs, model, shares, budget, text, keep, without)
    missed = {n: round(e, 4) for n, e in fit.errors.items() if abs(e) > MISSED}
    if missed:
        warnings.warn(f"no rates meet the targets; relative errors left: {missed}", stacklevel=2)
    return rows
