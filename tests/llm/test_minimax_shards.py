import random
import zlib
from collections import defaultdict

import pytest
from edges import TEXTS, documents, prose

from marlstone.llm import minimax_shards, queries


def brute(rows, shards):
    groups = defaultdict(lambda: [None, 0])
    for i, t in rows:
        g = groups[t]
        g[0] = i if g[0] is None else g[0] if i is None else min(g[0], i)
        g[1] += len((t or "").encode()) + 8
    sizes = [s for _, s in sorted(groups.values(), key=lambda g: (g[0] is not None, g[0] or 0))]

    def fits(c):
        k, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                k, room = k + 1, c
            room -= s
        return k <= shards

    low, high = 0, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def check(got, rows, shards):
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert len(got) == len(rows) and all(0 <= s < shards for s in per)
    assert all(sorted(r.slot for r in p) == list(range(len(p))) for p in per.values())
    assert max((sum(r.size for r in p) for p in per.values()), default=0) == brute(rows, shards)


@pytest.mark.parametrize("buckets", [4, 60, 8192])
def test_brute_force(spark, monkeypatch, buckets):
    monkeypatch.setattr(minimax_shards, "BUCKETS", buckets)
    rng = random.Random(buckets)
    rows = [(i, prose(rng.choice([0, 1, 5, 30, 400]), rng.randrange(150))) for i in range(250)]
    for shards in (1, 3, 24):
        check(minimax_shards.shard(documents(spark, rows), shards).collect(), rows, shards)


def test_equal_texts_stay_together(spark):
    rows = [(i, prose(20, i % 7)) for i in range(100)]
    got = minimax_shards.shard(documents(spark, rows), 5).collect()
    of = defaultdict(set)
    for r in got:
        of[dict(rows)[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in of.values())


def test_edges(spark):
    check(minimax_shards.shard(documents(spark), 4).collect(), TEXTS, 4)
    assert minimax_shards.shard(documents(spark, []), 4).count() == 0
    one = minimax_shards.shard(documents(spark, [(3, "x")]), 24).collect()
    assert (one[0].slot, len(one)) == (0, 1)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op8_minimax_shards(spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(got.collect(), rows, 24)


def test_native_plan(spark, sf):
    plan = queries.op8_minimax_shards(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shards_are_level(spark):
    """No shard is emptier than its neighbours allow; a group beyond a fair share leaves none empty."""
    rng = random.Random(1)
    rows = [(i, prose(rng.randint(20, 60), i)) for i in range(1200)]
    sizes = defaultdict(int)
    for r in minimax_shards.shard(documents(spark, rows), 24).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 24 and min(sizes.values()) > 0.9 * max(sizes.values())
    rows += [(i, rows[600][1]) for i in range(2000, 3000)]
    sizes = defaultdict(int)
    for r in minimax_shards.shard(documents(spark, rows), 24).collect():
        sizes[r.shard] += r.size
    rest = sorted(sizes.values())[:-1]
    assert len(sizes) == 24 and rest[0] > 0.6 * rest[-1]


def test_hot_groups_are_joined_whole(spark):
    """More groups than HOT would call hot, one of them hot: every row is found once."""
    from marlstone.llm.spread import HOT, join_spread

    many = spark.range(6000).selectExpr("id", "if(id % 3 = 0, 0, id) AS k", "cast(null AS int) AS m")
    one = many.groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "k * 2 AS v", "n")
    assert one.where(f"n * {HOT} > 6000").count() == 1
    got = join_spread(many, one, ["k"], "n")
    assert set(got.columns) == {"k", "id", "m", "v"}
    assert sorted((r.id, r.v) for r in got.collect()) == [(i, 0 if i % 3 == 0 else 2 * i) for i in range(6000)]


def test_salted_join(spark):
    """A key with most of the rows is cut into cells; nothing is lost or doubled."""
    from marlstone.llm.spread import join_salted

    many = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) AS k")
    one = spark.range(60).selectExpr("id AS k", "array_repeat(id, 3) AS big")
    got = join_salted(many, one, "k", 100)
    assert set(got.columns) == {"k", "id", "big"}
    assert sorted((r.id, r.k, r.big[0]) for r in got.collect()) == [(i, k, k) for i in range(9000) for k in [0 if i % 3 == 0 else i % 50]]
