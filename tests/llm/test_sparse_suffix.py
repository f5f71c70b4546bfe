import random

import numpy as np
import pyarrow as pa
import pytest
from edges import TEXTS, documents, prose

from marlstone.llm import queries, sparse_suffix


def brute(rows, least=sparse_suffix.MIN_WORDS):
    """doc_id to covered words, by every passage of ``least`` words in the texts."""
    words = {t: t.encode().split() for _, t in rows if t}
    seen = {}
    for t, w in words.items():
        for i in range(len(w) - least + 1):
            seen.setdefault(tuple(w[i : i + least]), set()).add(t)
    many = {t for t in words if sum(x == t for _, x in rows) > 1}
    out = []
    for i, t in rows:
        w = words.get(t, [])
        mark = np.zeros(len(w), bool)
        for a in range(len(w) - least + 1):
            if len(seen[tuple(w[a : a + least])]) > 1:
                mark[a : a + least] = True
        if t in many and len(w) >= least:
            mark[:] = True
        if mark.any():
            out.append((i, int(mark.sum())))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.dup_words) for r in df.collect()), key=str)


def near_copies(seed, n=60, size=260):
    rng = random.Random(seed)
    base = prose(size, seed).split()
    rows = []
    for i in range(n):
        w = base[:]
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        lo = rng.randrange(0, 120)
        rows.append((i, " ".join(w[lo : lo + rng.randint(40, size)])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_near_copies(spark, seed):
    rows = near_copies(seed) + [(1000, prose(400, 50 + seed)), (1001, "und " * 120), (1002, "und " * 90 + prose(60, 7)), (1003, "a b " * 60), (1004, "b a " * 70)]
    assert found(sparse_suffix.repeated_passages(documents(spark, rows))) == brute(rows)


def test_passage_in_many_documents(spark):
    passage = prose(55, 77)
    rows = [(i, f"{prose(40, i)} {passage} {prose(30, 500 + i)}") for i in range(300)]
    got = sparse_suffix.repeated_passages(documents(spark, rows))
    assert len(found(got)) == 300 and found(got) == brute(rows)


def test_edges(spark):
    got = sparse_suffix.repeated_passages(documents(spark)).collect()
    assert found(sparse_suffix.repeated_passages(documents(spark))) == brute(TEXTS)
    copies = [r for r in got if r.doc_id in (4, 5)]
    assert len(copies) == 3 and all(r.copies == 3 and r.copy_of == 4 for r in copies)
    assert sparse_suffix.repeated_passages(documents(spark, [])).count() == 0


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op6_repeated_passages(spark, sf)
    assert found(got) == brute(rows)
    texts = dict(rows)

    def passages(t):
        w = t.encode().split()
        return {tuple(w[i : i + 50]) for i in range(len(w) - 49)}

    for r in got.collect():
        assert r.partner is not None or r.copies > 1
        if r.partner is not None:
            assert texts[r.partner] != texts[r.doc_id] and passages(texts[r.partner]) & passages(texts[r.doc_id])
            assert r.partner == min(i for i, t in rows if t == texts[r.partner])
        w = texts[r.doc_id].encode().split()
        assert all(a["end"] < b["start"] for a, b in zip(r.spans, r.spans[1:])) and r.spans[-1]["end"] <= len(w)


def test_same_words_keep_the_same_places():
    rng = np.random.default_rng(0)
    passage = rng.integers(1, 2**63, 50, dtype=np.uint64)
    for _ in range(20):
        a, b = (np.concatenate([rng.integers(1, 2**63, rng.integers(0, 90), dtype=np.uint64), passage, rng.integers(1, 2**63, rng.integers(0, 90), dtype=np.uint64)]) for _ in range(2))
        shared = []
        for h in (a, b):
            at = int(np.flatnonzero(h == passage[0])[0])
            seeds = sparse_suffix.window_hashes(h, sparse_suffix.SEED_WORDS)
            p = sparse_suffix.selected(h, seeds) - at
            shared.append({int(x) for x in p if 0 <= x < sparse_suffix.WINDOW})
        assert shared[0] & shared[1]


def test_groups_too_large_to_hold(monkeypatch):
    """A key's suffixes beyond HELD are cut, and their passages are given out to be met."""
    monkeypatch.setattr(sparse_suffix, "HELD", 8)
    n = 40
    right = np.tile(np.arange(1, sparse_suffix.RIGHT + 1, dtype=">u4"), (n, 1))
    left = np.tile(np.arange(1, sparse_suffix.LEFT + 1, dtype=">u4"), (n, 1))
    batch = pa.RecordBatch.from_arrays([pa.array(np.full(n, 7)), sparse_suffix._fixed(right), sparse_suffix._fixed(left), pa.array([b"%04d" % i for i in range(n)]), pa.array(np.full(n, 30, np.int32))], names=["key", "right", "left", "digest", "at"])
    out = pa.Table.from_batches(list(sparse_suffix._neighbours(iter([batch])))).to_pylist()
    assert {r["digest"] for r in out if r["window"] is None} == {b"%04d" % i for i in range(n)}
    assert len({r["window"] for r in out if r["window"] is not None}) == sparse_suffix.WINDOW


def _suffix_batch(digests, at):
    n = len(digests)
    right = np.tile(np.arange(1, sparse_suffix.RIGHT + 1, dtype=">u4"), (n, 1))
    left = np.tile(np.arange(1, sparse_suffix.LEFT + 1, dtype=">u4"), (n, 1))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, 7)), sparse_suffix._fixed(right), sparse_suffix._fixed(left), pa.array(digests), pa.array(np.array(at, np.int32))], names=["key", "right", "left", "digest", "at"])


def test_all_places_of_a_text_are_given_out():
    """A range with one text gives out every place; one with two texts gives out both."""
    at = list(range(30, 330, 10))
    alone = [r for b in sparse_suffix._neighbours(iter([_suffix_batch([b"a"] * 30, at)])) for r in b.to_pylist() if r["window"] is not None]
    assert len({r["window"] for r in alone}) == sparse_suffix.WINDOW
    assert all(sorted(r["places"]) == at for r in alone)
    both = [r for b in sparse_suffix._neighbours(iter([_suffix_batch([b"a"] * 5 + [b"b"] * 5, [*at[:5], *at[:5]])])) for r in b.to_pylist() if r["window"] is not None]
    assert {r["window"] for r in both} == {r["window"] for r in alone}
    assert all({r["digest"] for r in both if r["window"] == w} == {b"a", b"b"} for w in {r["window"] for r in both})


def test_partner_in_another_chunk(spark, monkeypatch):
    """A text with many places of one passage whose only partner lies in another range or chunk."""
    rows = [(0, "una linea se repite aqui " * 400), (1, prose(30, 3) + " una linea se repite aqui" * 14), (2, prose(300, 4))]
    monkeypatch.setattr(sparse_suffix, "_neighbours", _in_small_chunks())
    assert found(sparse_suffix.repeated_passages(documents(spark, rows))) == brute(rows)


def _in_small_chunks():
    def work(batches):
        from marlstone.llm import sparse_suffix as there  # the worker's own, which is not patched

        there.HELD, held = 64, there.HELD
        yield from there._neighbours(batches)
        there.HELD = held

    return work
