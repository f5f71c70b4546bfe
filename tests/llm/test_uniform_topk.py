import glob
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import queries, uniform_topk


def brute(rows, is_query, k):
    """Every row of an id counts; a row of the query's own id does not."""
    good = [(i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for q in {i for i, _ in good if is_query(i)}:
        pairs = [(max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v, w)))), j) for i, v in good if i == q for j, w in good if j != q]
        out.update((q, r, j, s) for r, (s, j) in enumerate(sorted(pairs, key=lambda p: (-p[0], p[1]))[:k], 1))
    return out


def run(spark, rows, k=5, every=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    return Counter(tuple(r) for r in uniform_topk.top_k(df, F.col("vec_id") % every == 0, k).collect())


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, monkeypatch, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(3, 10))
    rows = [(i, (centers[i % 3] * (seed + 1) + rng.normal(size=10)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)] + [(2000 + i, [0.0] * 10) for i in range(20)]
    assert run(spark, rows) == brute(rows, lambda q: q % 3 == 0, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (3, None), (6, [1.0, None]), (9, [nan, 1.0]), (12, [inf, 1.0]), (None, [1.0, 1.0]), (1, [-1.0, -2.0]), (2, [3.0]), (0, [1.0, 2.0]), (15, [0.5, 0.5]), (15, [0.25, 0.5]), (18, [])]
    assert run(spark, rows) == brute(rows, lambda q: q % 3 == 0, 5)
    assert run(spark, [(0, [1.0])]) == Counter()
    assert run(spark, []) == Counter()
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == Counter()
    big = [(i, [1e5 * (i + 1), -1e5]) for i in range(7)]  # beyond exact doubles
    assert run(spark, big) == brute(big, lambda q: q % 3 == 0, 5)


def test_repeated_ids_and_wide_components(spark):
    assert run(spark, [(0, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [2.0, 0.0]), (3, [0.5, 0.5])], k=5, every=50) == Counter({(0, 1, 1, 131072): 1, (0, 2, 1, 131072): 1, (0, 3, 3, 65536): 1})
    assert run(spark, [(0, [3.0e6]), (1, [1.0])], every=50) == Counter({(0, 1, 1, 196_608_000_000): 1})
    rng = np.random.default_rng(4)
    wide = [(int(rng.integers(0, 40)), (rng.normal(size=6) * 10.0 ** rng.integers(0, 9)).tolist()) for _ in range(120)]
    wide += [(50, [3e38] * 6), (51, [-3e38] * 6)]
    assert run(spark, wide) == brute(wide, lambda q: q % 3 == 0, 5)


def test_equal_vectors_keep_enough():
    ids, c = np.array([5, 1, 9, 3, 7, 2, 1, 1, 8, 1]), np.array([[1, 1], [1, 1], [2, 2], [1, 1], [1, 1], [1, 1], [1, 1], [1, 1], [1, 1], [1, 1]])
    assert sorted(ids[uniform_topk.thinned(ids, c, 2)].tolist()) == [1, 1, 2, 3, 9]


def test_threshold_leaves_entries_untouched():
    """Exact against the full product, and lists of short candidates aren't computed."""
    rng = np.random.default_rng(2)
    c = np.floor(rng.normal(size=(3000, 32)) * 256 * 10.0 ** rng.uniform(-2, 0, size=(3000, 1)))
    q = np.floor(rng.normal(size=(20, 32)) * 256)
    whole = q @ c.T
    cut = np.sort(whole, axis=1)[:, -5]
    found, values, counts = uniform_topk.above(q, c, cut)
    for i in range(20):
        want = np.flatnonzero(whole[i] >= cut[i])
        assert found[i].tolist() == want.tolist() and values[i].tolist() == whole[i][want].tolist()
    assert counts["touched"] < 0.8 * counts["entries"] and counts["collected"] < 0.1 * counts["entries"] / uniform_topk.LISTS
    for low in (-cut, np.zeros(20)):
        found, _, _ = uniform_topk.above(q, c, low)
        assert all(f.tolist() == np.flatnonzero(w >= x).tolist() for f, w, x in zip(found, whole, low))


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    assert {tuple(r) for r in queries.op4_topk(spark, sf).collect()} == set(con.execute(queries.oracle_sql()["op4_topk"]).fetchall())


def test_cells_of_many_blocks(spark, monkeypatch):
    """Groups of blocks on both sides give the result of brute force, and blocks of vectors never go through the driver."""
    for name, value in (("CANDIDATES", 32), ("QUERIES", 8), ("QUERY_GROUP", 3), ("CANDIDATE_GROUP", 4)):
        monkeypatch.setattr(uniform_topk, name, value)
    rng = np.random.default_rng(9)
    rows = [(i % 500, (rng.normal(size=7) * (1 if i % 9 else 300)).tolist()) for i in range(600)] + [(1000 + i, [0.25] * 7) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = uniform_topk.top_k(df, F.col("vec_id") % 3 == 0, 5)
    assert Counter(tuple(r) for r in found.collect()) == brute(rows, lambda q: q % 3 == 0, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "block" in x]
