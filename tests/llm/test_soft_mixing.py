import numpy as np
import pytest
from edges import TEXTS, documents, labels
from pyspark.sql import functions as F

from marlstone.llm import queries, soft_mixing

NAMES = soft_mixing.DOMAINS


def optimal(n, p, goal, r):
    """Whether rates are the least squares: no document's rate can move along its gradient."""
    whole = (n[:, None] * p).sum(0)
    error = ((r * n) @ p - goal) / whole
    slope = p @ error + soft_mixing.PULL * (r - 1)
    return np.abs(slope[r > 0]).max(initial=0) < 1e-7 and slope[r == 0].min(initial=0) > -1e-7


def fitted(spark, n, p, goal):
    rows = spark.createDataFrame([(i, int(a), *map(float, b)) for i, (a, b) in enumerate(zip(n, p))], "i long, n_tokens long, p_clean double, p_junk double, p_toxic double")
    fit = soft_mixing.fit_rates(rows, dict(zip(NAMES, goal)), NAMES)
    return np.array([r.rate for r in rows.withColumn("rate", soft_mixing.rate_of(NAMES, fit.multipliers)).orderBy("i").collect()]), fit


def test_rates_are_those_of_projected_gradient(spark):
    rng = np.random.default_rng(0)
    n, p = rng.integers(1, 500, 300).astype(float), rng.dirichlet([0.3, 0.3, 0.3], 300)
    whole = (n[:, None] * p).sum(0)
    for shares in ([1.5, 0.6, 0.3], [1.5, 0.6, 0.05], [1.0, 1.0, 1.0]):
        goal = np.array(shares) * whole
        got, fit = fitted(spark, n, p, goal)
        assert (got >= 0).all() and optimal(n, p, goal, got)
        assert np.abs(((got * n) @ p - goal) / whole).max() < 1e-3 and fit.passes <= 20
        # Plain projected gradient, step by step, ends at the same objective.
        r = np.ones(len(n))
        for _ in range(5000):
            r = np.maximum(0, r - p @ (((r * n) @ p - goal) / whole) - soft_mixing.PULL * (r - 1))

        def objective(r):
            return ((((r * n) @ p - goal) ** 2) / whole).sum() + soft_mixing.PULL * (n * (r - 1) ** 2).sum()

        assert objective(got) <= objective(r) + 1e-6


def test_targets_that_no_rates_meet(spark):
    n, p = np.full(50, 100.0), np.tile([0.6, 0.3, 0.1], (50, 1))
    got, fit = fitted(spark, n, p, np.array([1.0, 1.0, 0.0]) * 100 * 50 * p[0])
    assert optimal(n, p, np.array([1.0, 1.0, 0.0]) * 100 * 50 * p[0], got) and fit.errors["toxic"] > 0.1
    assert soft_mixing.fit_rates(spark.createDataFrame([], "n_tokens long, p_clean double, p_junk double, p_toxic double"), {"clean": 1.0}, NAMES).errors == dict.fromkeys(NAMES, 0.0)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_query(spark, sf, size):
    base = sf.replace("sf0.001", size)
    rows = queries.op5_soft_mixing(spark, base).toPandas()
    docs = spark.read.parquet(f"{base}/documents.parquet").count()
    assert len(rows) == docs and rows.rate.min() >= 0
    assert np.allclose(rows[[f"p_{n}" for n in NAMES]].sum(axis=1), 1)
    n, p = rows.n_tokens.to_numpy(float), rows[[f"p_{n}" for n in NAMES]].to_numpy()
    whole = (n[:, None] * p).sum(0)
    assert ((rows.rate.to_numpy() * n) @ p / whole).tolist() == pytest.approx([queries.MIX_SHARES[x] for x in NAMES], abs=1e-3)


def test_held_out_accuracy(spark, sf):
    base = sf.replace("sf0.001", "sf0.1")
    docs, marks = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    fit = marks.where("doc_id % 2 = 0")
    model = soft_mixing.train(docs, fit, soft_mixing.domain_of(fit), NAMES)
    test = marks.where("doc_id % 2 = 1").withColumn("domain", soft_mixing.domain_of(marks))
    got = soft_mixing.with_posteriors(docs.select("doc_id", "text"), model).join(test, "doc_id").where("n_tokens >= 20").toPandas()
    right = got[[f"p_{n}" for n in NAMES]].to_numpy().argmax(axis=1) == got.domain.map(NAMES.index)
    assert right.mean() > 0.9  # some labels don't follow from the text
    clean = got.domain == "clean"
    assert right[clean].mean() > 0.98


def test_edges(spark):
    docs = documents(spark)
    marks = labels(spark, [(4, 1, 0), (4, 1, 0), (9, 0, 0), (10, 1, 1), (99, 1, 1), (None, 0, 0), (6, None, None)])
    model = soft_mixing.train(docs, marks, soft_mixing.domain_of(marks), NAMES)
    out = soft_mixing.mix(docs, model, {"clean": 1.0})
    assert out.count() == len(TEXTS) and out.where("rate is null or isnan(rate)").count() == 0
    assert out.where("text is null").agg(F.max("n_tokens")).first()[0] == 0
    flat = soft_mixing.train(docs, labels(spark), soft_mixing.domain_of(labels(spark)), NAMES)
    assert soft_mixing.with_posteriors(docs, flat).first().p_junk == pytest.approx(1 / 3)
    assert soft_mixing.mix(documents(spark, []), model, {"clean": 1.0}).count() == 0


def test_copies_keep_the_totals(spark):
    rates = [0.0, 0.25, 0.5, 1.0, 1.05, 1.4, 1.5, 2.75]
    rows = spark.createDataFrame([(i, rates[i % 8]) for i in range(16_000)], "i long, rate double")
    got = rows.withColumn("n", soft_mixing.copies(F.col("rate"), F.col("i"))).groupBy("rate").agg(F.avg("n").alias("mean"), F.min("n").alias("low"), F.max("n").alias("high")).collect()
    assert len(got) == 8
    for r in got:
        assert r.mean == pytest.approx(r.rate, abs=0.04)
        assert (r.low, r.high) == (np.floor(r.rate), np.ceil(r.rate))
