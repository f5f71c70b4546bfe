"""Every registered query of the corpus operators against its SQL."""

import glob
import os

import duckdb
import pytest

from marlstone.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool) or str(type(v)).endswith("bool'>"):
        return bool(v)
    try:
        return round(float(v), 9) if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, duck, sf, name):
    got = catalog.queries()[name](spark, sf)
    rows = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in rows.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rows.fetchall()), key=str)
    have = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=str)
    assert have == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() >= 0


def test_blake2b_clusters_by_brute_force(spark, sf):
    import hashlib
    import re

    sketch = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = [x for x in re.split("[^a-z]+", (r.text or "").lower()) if x]
        if len(w) >= 120:
            h = {int.from_bytes(hashlib.blake2b(" ".join(w[i : i + 5]).encode(), digest_size=8).digest(), "big") for i in range(len(w) - 4)}
            sketch[r.doc_id] = (len(w), sorted(h)[:256])
    root = {i: i for i in sketch}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sketch)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            (n, x), (m, y) = sketch[i], sketch[j]
            window = set(sorted(set(x) | set(y))[:256])
            if max(n, m) <= 1.4 * min(n, m) and len(window & set(x) & set(y)) / len(window) >= 0.7:
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    groups = {i: find(i) for i in ids}
    want = {(i, f"nd{g}") for i, g in groups.items() if sum(x == g for x in groups.values()) > 1}
    assert want and {(r.doc_id, r.near_duplicate_group) for r in catalog.queries()["neardup_blake2b"](spark, sf).collect()} == want


def test_english_search_by_scanning(spark, sf):
    import re

    from marlstone.functions.stemmer import STOP_WORDS, stem

    wanted = {stem("tokens"), stem("insulting")}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {r.doc_id for r in docs if wanted & {stem(w) for w in re.findall("[a-z0-9]+", (r.text or "").lower()) if w not in STOP_WORDS}}
    assert {r.doc_id for r in catalog.queries()["search_english"](spark, sf).collect()} == want


def test_fuzzy_tier_by_scanning(spark, sf):
    """Counts against difflib over every window, with normalising done here."""
    import difflib
    import re
    import unicodedata
    from collections import Counter

    def normal(t):
        t = re.sub("[\u200b-\u200f\u00ad\ufeff]", "", unicodedata.normalize("NFKC", t))
        return re.sub(r"\s+", " ", re.sub(r"-\s*", "", t.translate(str.maketrans("‘’“”–—−", "\'\'\"\"---")))).strip().lower()

    want = Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        body, cut = normal(r.text or ""), (r.text or "")[:80]
        q = normal(cut[:20] + "q" + cut[21:81])
        windows = range(0, max(1, len(body) - len(q) + 1), max(1, len(q) // 4))
        like = q and any(difflib.SequenceMatcher(None, q, body[a : a + len(q)]).ratio() >= 0.92 for a in windows)
        want["not found" if not q else "substring" if q in body else "fuzzy" if like else "not found"] += 1
    assert {r.how: r.n for r in catalog.queries()["fuzzy_evidence"](spark, sf).collect()} == dict(want) and want["fuzzy"]


def test_stored_index_is_built_once(spark, sf):
    from marlstone.operators import search

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, two = (search.stored(docs.select("doc_id", "text")).inputFiles() for _ in range(2))
    assert sorted(one) == sorted(two)
    assert sorted(search.stored(docs.limit(5), config="english").inputFiles()) != sorted(one)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 54
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nothing_else_imports_the_llm_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for path in glob.glob(f"{root}/marlstone/**/*.py", recursive=True):
        if "/llm/" not in path:
            assert "marlstone.llm" not in open(path).read(), path


def test_fuzzy_evidence_checks_every_document(spark, sf):
    found = catalog.queries()["fuzzy_evidence"](spark, sf).collect()
    assert sum(r.n for r in found) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_validation_of_repeated_and_odd_rows(spark, tmp_path):
    """Label rows that share an id, also by the shift of every 37th, documents that do, and texts whose cut is blank or changes when normalized."""
    texts = [None, "", "a", "ab", "   ", "x -- " + "-" * 50, "ab" + " " * 60 + "end", "xy\u0301 and so on, further than the cut goes", "ab" + "\u200b" * 45 + "c", "\u039f\u0394\u039f\u03a3" * 15, "ab" + "c" * 39 + "e\u0301 tail", "word " * 30, "Stra\u00dfe, " * 20, "xx" + "y" * 38 + " \u0301z"]
    docs = [(i, texts[i % len(texts)], "en", "web", 0) for i in range(1, 900)] + [(1_000_000_037, "far away and long enough for a cut of forty", "en", "web", 0), (8, "again, under the same id as another text", "en", "web", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in [*range(1, 900), *range(1, 300), 1_000_000_037]] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(con.execute(catalog.oracle_sql()["validation_reasons"]).fetchall(), key=str)
    assert sorted((tuple(r) for r in catalog.queries()["validation_reasons"](spark, str(tmp_path)).select("doc_id", "reason").collect()), key=str) == want
