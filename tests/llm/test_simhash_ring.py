import random
import re

import numpy as np
import pytest
import xxhash
from edges import TEXTS, documents, prose
from pyspark.sql import functions as F

from marlstone.llm import queries, simhash_ring


def plain(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, fps):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= 4) + i + 1:
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return [low[find(i)] for i in range(len(ids))]


def expected(rows):
    fps = [plain(t) for _, t in rows]
    return sorted(((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, components([i for i, _ in rows], fps))), key=str)


def test_edges(spark):
    assert sorted((tuple(r) for r in simhash_ring.near_duplicates(documents(spark)).collect()), key=str) == expected(TEXTS)
    assert simhash_ring.near_duplicates(documents(spark, [])).count() == 0


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op9_simhash(spark, sf).collect()), key=str) == expected(rows)


@pytest.mark.parametrize("bucket", [4, 1024])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash_ring, "BUCKET", bucket)
    rng = random.Random(bucket)
    fps = {0, 1, (1 << 64) - 1}
    for _ in range(12):
        c = rng.getrandbits(64)
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
            c = x if rng.random() < 0.4 else c
    fps = sorted(fps)
    rows = spark.createDataFrame([(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)], "doc_id long, fp long")
    of = {r.fp: r.component for r in simhash_ring._labels(rows).collect()}
    want = components(list(range(len(fps))), fps)
    got = [of[int(np.uint64(f).astype(np.int64))] for f in fps]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_chain_principle():
    """Two fingerprints within the distance share a bucket whose chains hold; beyond it none do."""
    rng = random.Random(0)
    for _ in range(500):
        a = rng.getrandbits(64)
        k = rng.randint(0, 7)
        b = a
        for bit in rng.sample(range(64), k):
            b ^= 1 << bit
        x = np.array([a, b], np.uint64)
        found, segment = simhash_ring.keys(x)
        shared = {int(segment[c]) for c in np.flatnonzero(found[0] == found[1])}
        ok = any(simhash_ring.chains_hold(x[:1] ^ x[1:], s)[0] for s in shared)
        assert ok == (k <= 4)


def test_keep_one(spark):
    rows = [(i, prose(200, 1)) for i in range(5, 15)] + [(4, prose(200, 1) + " x"), (20, prose(200, 2)), (20, prose(200, 2)), (None, prose(200, 2)), (None, prose(200, 3)), (21, prose(200, 4)), (21, prose(200, 5))]
    docs = documents(spark, rows)
    kept = simhash_ring.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(4, rows[10][1]), (20, rows[11][1]), (None, rows[14][1]), (21, rows[15][1]), (21, rows[16][1])], key=str)
    assert simhash_ring.keep_one(documents(spark, [])).count() == 0
    assert simhash_ring.keep_one(documents(spark)).where(F.col("doc_id").isin(4, 5, 12)).count() == 1


def _shingle_set(text):
    words = re.split(r"[\x20\x09-\x0D]+", text.lower().strip())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_copies_beyond_the_fingerprints_distance(spark):
    """Texts of five-word Jaccard 0.8 or more leave one, wherever their fingerprints are; less alike ones stay."""
    rng, rows = random.Random(3), []
    for g in range(40):
        base = prose(120, 900 + g).split()
        rows.append((10 * g, " ".join(base)))
        for k in range(1, 4):
            w = base[:]
            for at in rng.sample(range(5, 115), 2):
                w[at] = f"edit{rng.randrange(10**6)}"
            rows.append((10 * g + k, " ".join(w)))
    alike = [(i, j) for i, a in rows for j, b in rows if i < j and i // 10 == j // 10 and len(_shingle_set(a) & _shingle_set(b)) >= 0.8 * len(_shingle_set(a) | _shingle_set(b))]
    text = dict(rows)
    assert any((plain(text[i]) ^ plain(text[j])).bit_count() > simhash_ring.DISTANCE for i, j in alike)
    kept = {r.doc_id for r in simhash_ring.keep_one(documents(spark, rows), similarity=0.8).collect()}
    assert not any(i in kept and j in kept for i, j in alike)
    assert {i - i % 10 for i in kept} == {10 * g for g in range(40)}
    changed = [(i, " ".join(w if n % 12 else f"new{i}" for n, w in enumerate(t.split()))) for i, t in rows if i % 10 == 0]
    low = [(i + 5, t) for i, t in changed]
    ids = {r.doc_id for r in simhash_ring.keep_one(documents(spark, [r for r in rows if r[0] % 10 == 0] + low), similarity=0.8).collect()}
    plainly = {r.doc_id for r in simhash_ring.keep_one(documents(spark, [r for r in rows if r[0] % 10 == 0] + low)).collect()}
    assert ids == plainly


def test_stage_links_near_copies(spark, sf):
    import corpus_pipeline

    base = prose(120, 61).split()
    rows, far = [(1, " ".join(base))], 0
    for k in range(2, 12):
        w = base[:]
        w[40 + k], w[80 - k] = f"one{k}", f"two{k}"
        rows.append((k, " ".join(w)))
        far += (plain(rows[0][1]) ^ plain(rows[-1][1])).bit_count() > simhash_ring.DISTANCE
    assert far
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), sf).collect()] == [1]


def test_large_buckets_lose_no_link(spark):
    """One bucket of families of like texts: every family is linked, not only those of the smallest and the largest member."""
    import random

    from marlstone.llm import shingle_bands

    pick, texts = random.Random(1), []
    for family in range(120):
        words = [f"w{family}x{i}" for i in range(100)]
        for copy in range(5):
            mine = list(words)
            mine[pick.randrange(100)] = f"new{family}and{copy}"
            texts.append((len(texts) * 7919 % 600, family, " ".join(mine)))
    assert len({i for i, _, _ in texts}) == 600 > shingle_bands.PART > shingle_bands.FEW
    rows = spark.createDataFrame([(i, 1000 + i, [5]) for i, _, _ in texts], "id long, group long, bands array<long>")
    found = shingle_bands.links(rows, spark.createDataFrame([(i, t) for i, _, t in texts], "id long, text string"), 0.8).collect()
    family, root = {1000 + i: f for i, f, _ in texts}, {1000 + i: 1000 + i for i, _, _ in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in found:
        assert family[u] == family[v]
        root[find(u)] = find(v)
    assert len({find(i) for i in root}) == 120


def test_large_buckets_write_no_pairs(spark, monkeypatch):
    """One bucket of unlike texts and two families: tables grow with the members, not with their pairs, and the families are linked."""
    from marlstone.llm import shingle_bands

    rng, sizes = random.Random(2), {}
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(1000)]
    for family in range(2):
        words = [f"f{family}x{k}" for k in range(100)]
        texts += [(1000 + 300 * family + i, " ".join(w if k != i % 100 else f"new{i}" for k, w in enumerate(words))) for i in range(300)]
    rng.shuffle(texts)
    write = shingle_bands.materialize

    def watched(df, name):
        made = write(df, name)
        sizes[name] = max(sizes.get(name, 0), made.count())
        return made

    monkeypatch.setattr(shingle_bands, "materialize", watched)
    rows = spark.createDataFrame([(i, 5000 + i, [7, 8]) for i, _ in texts], "id long, group long, bands array<long>")
    found = shingle_bands.links(rows, spark.createDataFrame(texts, "id long, text string"), 0.8).collect()
    assert max(sizes.values()) < 4 * len(texts), sizes
    root = {5000 + i: 5000 + i for i, _ in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in found:
        assert (u - 6000) // 300 == (v - 6000) // 300 in (0, 1)
        root[find(u)] = find(v)
    assert len({find(i) for i in root}) == 1002


def test_few_jobs(spark):
    """The driver keeps something of every job; links that one task can join take no rounds."""
    rows = [(10 * g + k, prose(120, 700 + g) + f" one more {k}" * (k > 0)) for g in range(20) for k in range(3)]
    spark.sparkContext.setJobGroup("few-jobs", "")
    try:
        kept = {r.doc_id for r in simhash_ring.keep_one(documents(spark, rows), similarity=0.8).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert kept == {10 * g for g in range(20)}
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) < 100
