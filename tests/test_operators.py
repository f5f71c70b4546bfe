"""Operators on planted rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.operators import agreement, components, evidence, exports, merge, neardup, quality, report, search, upsert, validate
from marlstone.sources import pages, records, sinks
from marlstone.streaming.ingest import ingest_new

NOW = dt.datetime(2026, 1, 1)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# -- agreement -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "pairs,expected",
    [
        ([(0, 0), (0, 0)], 1.0),
        ([(0, 0), (5, 5)], 1.0),
        ([(0, 5), (5, 0)], -0.5),
        ([(1, 2)], 0.0),
        ([(0, 0), (0, 1), (1, 1), (4, 4), (5, 5), (3, 5)], 0.832112332112332),
    ],
)
def test_alpha(spark, pairs, expected):
    df = spark.createDataFrame([("s", a, b) for a, b in pairs], "scale string, a int, b int")
    assert agreement.alpha_ordinal(df).first().alpha == pytest.approx(expected)


def test_agreement_of_nulls(spark):
    df = spark.createDataFrame([("f", None, None), ("f", None, "x"), ("f", "x", "x")], "field string, a string, b string")
    assert agreement.nominal(df).first().same == 2
    empty = spark.createDataFrame([], "scale string, a int, b int")
    assert agreement.rates(empty).count() == agreement.alpha_ordinal(empty).count() == 0


# -- reports ---------------------------------------------------------------------------


def scores(spark, rows):
    return spark.createDataFrame(rows, "document_id long, completeness string, scale string, score int, status string, required boolean")


def test_distribution(spark):
    s = scores(spark, [(1, "full", "ai", 4, "clear", True), (2, "full", "ai", 0, "undecided", None), (3, "stub", "ai", 5, "clear", False), (4, None, "ai", 1, "clear", None), (5, "full", "ai", 4, "clear", False)])
    sec = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None), (3, ""), (None, "z")], "document_id long, instructor string")
    got = {(r.score, r.denominator): (r.n, r.total) for r in report.bin_distribution(s, sec).collect()}
    assert len(got) == 18
    assert got[4, "documents"] == (2, 2) and got[4, "sections"] == (2, 5) and got[4, "instructors"] == (2, 3)
    assert got[0, "documents"] == (0, 2)
    shares = report.addressed_shares(s, sec).first()
    assert (shares.addressed, shares.strict, shares.strict_pct, shares.middle) == (2, 2, 100.0, 0)
    need = report.required_share(s, sec).first()
    assert (need.full, need.required, need.required_sections) == (3, 1, 2)
    assert tuple(report.totals(s, sec).first()) == (5, 5, 3)
    assert report.status_counts(s).first().unclear == 1


def test_published_arithmetic(spark):
    counts = [580, 39, 450, 1166, 733, 981]
    s = spark.createDataFrame([(b, n) for b, n in enumerate(counts)], "score int, n int").withColumn("document_id", F.explode(F.sequence(F.lit(1), F.col("n"))))
    s = s.select(F.col("document_id").cast("long"), F.lit("full").alias("completeness"), F.lit("ai").alias("scale"), "score", F.lit("clear").alias("status"), F.lit(False).alias("required"))
    got = report.strict_share(s).first()
    assert (got.strict, got.addressed, round(got.strict_pct, 1)) == (1714, 3369, 50.9)


# -- merging and upserts ---------------------------------------------------------------


def test_cross_source_merge(spark):
    pdf = spark.createDataFrame([("p1", True, "h1", None, 10, None, "a.pdf", True, "c", NOW, None, 0), ("p2", True, "h1", None, 11, None, "b.pdf", True, "c", NOW, None, 1), ("p3", False, None, None, None, None, None, None, "c", NOW, "404", 2)], S.FETCH_LOG.add("seq", "long") if "seq" not in S.FETCH_LOG.names else S.FETCH_LOG)
    page = spark.createDataFrame([("w1", True, "u", "t", None, 3, "h1", None, "w.txt", "c", NOW, None, 0), ("w2", True, "u2", "t", "May", 3, "h2", None, "w.txt", "c", NOW, None, 1)], S.PAGE_LOG.add("seq", "long") if "seq" not in S.PAGE_LOG.names else S.PAGE_LOG)
    ext = spark.createDataFrame([("h1", 2, "text_layer", False, 9, 4.5, "x.txt", True, None, 0), ("h1", None, "failed", None, None, None, None, False, "boom", 1)], S.EXTRACTION_LOG.add("seq", "long") if "seq" not in S.EXTRACTION_LOG.names else S.EXTRACTION_LOG)
    texts = spark.createDataFrame([("x.txt", "body"), ("w.txt", "web")], "path string, text string")
    docs, by_source = merge.build_documents(pdf, page, ext, texts)
    got = {r.content_sha256: r for r in docs.collect()}
    assert got["h1"].source_kind == "pdf" and got["h1"].source_ids == ["p1", "p2", "w1"] and got["h1"].original_filename == "a.pdf"
    assert got["h1"].body is None and got["h1"].extract_tier == "failed"  # the last extraction counts
    assert got["h2"].source_kind == "simple_syllabus" and got["h2"].body == "web"
    assert rows_of(by_source, "source_id", "content_sha256") == [("p1", "h1"), ("p2", "h1"), ("w1", "h1"), ("w2", "h2")]
    manifest = spark.createDataFrame([("2026 Fall", "C1", "1", "T", "", "", "", "", "AB ", "download_pdf", "p1", ""), ("2026 Fall", "C2", "2", "T", "x", "cv", "", "", "AB", "none", None, ""), ("2026 Fall", "C3", "3", "T", "x", "", "", "", "AB", "download_pdf", "p9", "")], S.MANIFEST)
    sec = merge.build_sections(manifest, by_source, docs.withColumn("id", F.lit(7).cast("long")))
    assert rows_of(sec, "unique_number", "department", "document_id", "cv_url", "unmatched", "semester_code") == [("1", "AB", 7, None, False, 20269), ("2", "AB", None, "cv", False, 20269), ("3", "AB", None, None, True, 20269)]
    assert merge.syllabi(sec, docs.withColumn("id", F.lit(7).cast("long")).where("content_sha256 = 'h1'")).count() == 1


def documents(spark, rows):
    return spark.createDataFrame([(i, h, "pdf", s, None, None, None, None, b, "t", c, None, None, f) for i, h, s, b, c, f in rows], S.DOCUMENTS)


def test_upsert_documents(spark):
    later = NOW + dt.timedelta(days=1)
    old = documents(spark, [(1, "a", ["x"], "A", 1, NOW), (2, "b", ["x"], None, 1, NOW), (3, "c", ["x"], "C", 1, NOW), (4, "d", ["x"], "D", 1, NOW), (5, "e", ["x", "y"], "E", 1, NOW)])
    new = documents(spark, [(None, "a", ["x"], "A", 1, later), (None, "b", ["x"], "B", 1, later), (None, "c", ["x"], None, 1, later), (None, "e", ["y", "x"], "E", 1, later), (None, "z", [], "Z", 1, later), (None, "y", [], "Y", 1, later)]).drop("id")
    got = {r.content_sha256: r for r in upsert.upsert_documents(old, new).collect()}
    kinds = {k: r[upsert.CHANGE] for k, r in got.items()}
    assert kinds == {"a": "unchanged", "b": "updated", "c": "updated", "d": "kept", "e": "updated", "y": "inserted", "z": "inserted"}
    assert got["a"].fetched_at == NOW and got["b"].body == "B" and got["c"].body is None
    assert (got["y"].id, got["z"].id) == (6, 7)
    once = upsert.upsert_documents(old, new).drop(upsert.CHANGE)
    again = upsert.upsert_documents(once, new)
    assert again.where(F.col(upsert.CHANGE).isin("inserted", "updated")).count() == 0


def test_upsert_policies_keeps_model(spark):
    kind = "document_id long, prompt_version string, ai_score int, model string"
    out = upsert.upsert_policies(spark.createDataFrame([(1, "v", 2, "human")], kind), spark.createDataFrame([(1, "v", 3, "subagent"), (2, "v", 1, "subagent")], kind))
    assert rows_of(out, "document_id", "ai_score", "model") == [(1, 3, "human"), (2, 1, "subagent")]


def test_swap(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(3).write.parquet(path)
    sinks.swap(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2


# -- quality ---------------------------------------------------------------------------


def test_extraction(spark):
    dense, words = "q" * 600, "the cat and the dog of a house to you in here for all " * 20
    rows = [("dense", words, 1, None, False), ("garbled", dense, 1, "ocr text", False), ("sparse", "tiny", 1, "ocr text", False), ("exact", "a" * 200, 1, None, False), ("zero", "a" * 200, 0, None, False), ("locked", words, 1, None, True), ("lost", None, 3, None, False)]
    got = {r.n: r for r in quality.extraction(spark.createDataFrame(rows, "n string, text string, pages int, o string, e boolean"), ocr="o", encrypted="e").collect()}
    assert {k: (r.tier, r.garbled_text_layer) for k, r in got.items()} == {"dense": ("text_layer", False), "garbled": ("ocr", True), "sparse": ("ocr", False), "exact": ("text_layer", False), "zero": ("text_layer", False), "locked": ("encrypted", False), "lost": ("failed", False)}
    assert got["sparse"].chars == 8 and got["lost"].chars is None


# -- evidence and validation -----------------------------------------------------------

BODY = "Phones must be silenced. Lap-\ntops are allowed for notes only, and the use of chat assistants is prohibited in all graded work this term."


def record(i, seq, **over):
    base = {"document_id": i, "document_completeness": "full", "coder_notes": "", "seq": seq}
    for s in S.SCALES:
        base |= {f"{s}_score": 0, f"{s}_label": "not addressed", f"{s}_required": False, f"{s}_status": "clear", f"{s}_evidence": None, f"{s}_confidence": "high"}
    return base | over


PROHIBITED = {"ai_score": 5, "ai_label": "Prohibited", "ai_evidence": ["chat assistants is prohibited"]}
CASES = [
    (record(9, 0), "not a document we asked for"),
    (record(2, 1), "quarantined or empty document, refusing to score"),
    (record(1, 2, document_completeness="half"), "document_completeness not full/stub"),
    (record(1, 3, phone_status="open"), "phone status invalid"),
    (record(1, 4, laptop_score=6), "laptop score not 0-5"),
    (record(1, 5, ai_score=3, ai_label="discouraged", ai_evidence=["x"]), "ai label does not match score"),
    (record(1, 6, phone_confidence="sure"), "phone confidence invalid"),
    (record(1, 7, phone_required=None), "phone required must be true/false"),
    (record(1, 8, phone_evidence=["Phones"]), "phone scored 0 and clear, but has evidence"),
    (record(1, 9, phone_status="undecided"), "phone unsettled but cites nothing"),
    (record(1, 10, phone_score=2, phone_label="permitted"), "phone scored with no evidence"),
    (record(1, 11, phone_score=2, phone_label="permitted", phone_evidence=["nowhere to be seen in this text"]), "phone evidence not found in document"),
    (record(1, 12, phone_score=2, phone_label="permitted", phone_evidence=["nowhere to be seen in this text"], laptop_status="open"), "phone evidence not found in document"),
    (record(1, 13, phone_status="open", phone_score=2, phone_evidence=["nowhere to be seen"]), "phone status invalid"),
    (record(1, 14, **PROHIBITED), None),
    (record(1, 15, **PROHIBITED), "duplicate record"),
    (record(1, 16, phone_status="open"), "duplicate record"),
    (record(3, 17, laptop_score=2, laptop_label="permitted", laptop_evidence=["phones must be silenced. lap- tops ara allowed for notes"]), None),
]


def test_validation(spark):
    schema = S.CODER_RECORD.add("seq", "long") if "seq" not in S.CODER_RECORD.names else S.CODER_RECORD
    recs = spark.createDataFrame([tuple(r[n] for n in schema.names) for r, _ in CASES], schema)
    docs = spark.createDataFrame([(1, BODY), (2, None), (3, BODY)], "id long, body string")
    checked = validate.check(recs, docs).cache()
    got = {r.seq: r.reason for r in checked.collect()}
    assert got == {r["seq"]: why for r, why in CASES}
    policies = {r.document_id: r for r in validate.to_policies(checked, "v7").collect()}
    assert policies[1].ai_label == "prohibited" and policies[1].evidence_notes is None
    assert policies[3].evidence_notes == "laptop: matched after normalizing extraction noise"
    assert set(policies[1].asDict()) == set(S.POLICIES.names)
    assert validate.to_rejects(checked, "v7").count() == len(CASES) - 2


def test_audit(spark):
    schema = "document_id long, " + ", ".join(f"{s}_score int, {s}_evidence string" for s in S.SCALES)
    rows = [(1, 5, "Phones must be\n\nallowed for notes", 0, "never there", 2, "made up entirely by someone"), (2, 5, "x", None, None, None, None)]
    docs = spark.createDataFrame([(1, BODY), (2, None)], "id long, body string")
    counts, missing = evidence.audit(spark.createDataFrame(rows, schema), docs, S.SCALES)
    got = counts.first()
    assert (got.rows_audited, got.checked, got.exact, got.normalized, got.not_found) == (1, 3, 2, 0, 1)
    assert missing.first().scale == "ai"
    none = evidence.audit(spark.createDataFrame([], schema), docs, S.SCALES)[0].first()
    assert none.checked == 0 and none.exact_pct is None


def test_batch_gate(spark):
    files = spark.createDataFrame([("full", True, 2), ("short", True, 1), ("held", True, 1), ("free", True, 1), ("bad", False, None)], "file string, valid boolean, n_records long")
    wanted = spark.createDataFrame([("full", 1), ("full", 2), ("short", 1), ("short", 2), ("held", 1), ("held", 9)], "file string, document_id long")
    got = {r.file: r.reason for r in validate.batch_gate(files, wanted, spark.createDataFrame([(9,)], "document_id long")).collect()}
    assert got["full"] is got["held"] is got["free"] is None
    assert got["short"] == "1 of 2 records - incomplete" and got["bad"].startswith("not valid JSON")


# -- near-duplicates -------------------------------------------------------------------

RNG = random.Random(5)
LETTERS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(4000)]


def text(n, seed):
    rng = random.Random(seed)
    return [rng.choice(LETTERS) for _ in range(n)]


def test_near_duplicates(spark):
    base = text(300, 1)
    chain_b = base[:]
    chain_b[100:130] = text(30, 2)
    chain_c = chain_b[:]
    chain_c[200:230] = text(30, 3)
    docs = [(1, base), (2, ["new"] + base), (3, base + ["12", "34"]), (4, text(300, 9)), (5, text(119, 4)), (6, text(119, 4)), (7, chain_b), (8, chain_c)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in docs] + [(9, None), (10, "")], "doc_id long, text string")
    for name in neardup.HASHES:
        pairs, members = neardup.linked(docs, hash_name=name)
        found = neardup.clusters(pairs, members)
        assert rows_of(found, "doc_id", "root", "size") == [(i, 1, 5) for i in (1, 2, 3, 7, 8)]
    got = neardup.statistics(docs, found).first()
    assert (got.examined, got.clusters, got.inside, got.redundant) == (9, 1, 5, 4)
    again = neardup.write_back(docs, found, "doc_id")
    assert again.where("near_duplicate_group = 'nd1'").count() == 5


def test_prefix_join_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    sk = {r.doc_id: (r.n_words, set(r.sketch)) for r in neardup.sketches(docs).collect()}
    want = set()
    for a, (n, x) in sk.items():
        for b, (m, y) in sk.items():
            if a < b and max(n, m) <= min(n, m) * 1.4:
                window = sorted(x | y)[: neardup.SKETCH]
                if sum(h in x and h in y for h in window) / len(window) >= neardup.THRESHOLD:
                    want.add((a, b))
    got = {(r.a, r.b) for r in neardup.similar_pairs(neardup.sketches(docs)).collect()}
    assert got == want


def test_length_band(spark):
    assert not 231 <= 165 * 1.4 and 230 <= 165 * 1.4


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(rows_of(components.connected_components(spark.createDataFrame(edges, "u long, v long")), "node", "component"))
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# -- search ----------------------------------------------------------------------------


def test_search(spark):
    docs = spark.createDataFrame([(1, "Phones are banned in class"), (2, "class phones, allowed"), (3, "banned books"), (4, None), (5, "the policies of classes")], "doc_id long, text string")
    posted = search.postings(docs).cache()

    def find(q, **k):
        return [r.doc_id for r in search.search(posted, q, **k).orderBy("doc_id").collect()]

    assert find("phones") == [1, 2] and find("phones banned") == [1] and find("books or allowed") == [2, 3]
    assert find("phones -banned") == [2] and find('"class phones"') == [2] and find('"phones class"') == []
    assert find("") == [] and find("-phones", all_docs=docs) == [3, 4, 5]
    english = search.postings(docs, config="english")
    assert [r.doc_id for r in search.search(english, "policy class", "english").collect()] == [5]
    assert [r.doc_id for r in search.search(english, '"policies of class"', "english").collect()] == [5]


# -- sources and sinks -----------------------------------------------------------------


def test_records(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"sha256": "a", "ok": false}\n\n{broken\n{"sha256": "a", "ok": true}\n')
    path = f"file://{tmp_path}/log.jsonl"
    assert records.read_jsonl(spark, path, S.EXTRACTION_LOG, strict=False).count() == 2
    with pytest.raises(Exception):
        records.read_jsonl(spark, path, S.EXTRACTION_LOG).collect()
    good, bad = records.read_jsonl_counted(spark, path, S.EXTRACTION_LOG)
    assert (good.count(), bad.count()) == (2, 1)
    assert records.read_jsonl(spark, f"file://{tmp_path}/none", S.EXTRACTION_LOG).count() == 0


def test_json_folder(spark, tmp_path):
    for n, t in (("batch_1.json", '[{"document_id": 1, "ai_score": 2}, {"document_id": 2}]'), ("batch_2.json", '{"document_id": 1, "ai_score": 5}'), ("batch_3.json", "[{")):
        (tmp_path / n).write_text(t)
    files = records.read_json_folder(spark, f"file://{tmp_path}/batch_*.json")
    assert rows_of(files, "file", "valid", "n_records") == [("batch_1.json", True, 2), ("batch_2.json", True, 1), ("batch_3.json", False, None)]
    last = records.last_file_wins(records.records_of(files, S.CODER_RECORD))
    assert rows_of(last, "document_id", "ai_score") == [(1, 5), (2, None)]


def test_listing_pages(spark):
    cells = "".join(f"<td> {c} </td>" for c in ("2026 Fall", "C 1", "123", "Title", "A", "cv")) + '<td><a href="/download/55/">s</a></td><td></td>'
    html = f'<select name="department"><option value="">-</option><option value="AB ">x</option></select>Limiting results<table id="results_table"><thead><tr><td>h</td></tr></thead><tbody><tr>{cells}</tr><tr><td>short</td></tr></tbody></table>'
    page = spark.createDataFrame([("AB", html), ("CD", None)], "dept string, html string")
    got = pages.listing_rows(page).collect()
    assert len(got) == 1 and (got[0].course, got[0].unique, got[0].kind, got[0].doc_id, got[0].dept) == ("C 1", "123", "download_pdf", "55", "AB")
    flags = page.select(pages.is_cut(F.col("html")).alias("c"), pages.option_codes(F.col("html")).alias("o")).collect()
    assert flags[0].c and flags[0].o == ["AB "] and not flags[1].c


def test_exports_and_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "id long, body string")
    sample = spark.createDataFrame([(2, "dev"), (1, "gold"), (3, "dev")], S.POLICY_SAMPLE)
    assert [r.document_id for r in exports.selected(docs, sample, "dev").collect()] == [2]
    everything = exports.selected(docs, None, "all")
    assert [r.document_id for r in everything.collect()] == [1, 2]
    before = spark.createDataFrame([("1.txt", "old"), ("2.txt", "b")], "file string, text string")
    assert rows_of(sinks.export_texts(everything, before), "file", "stale") == [("1.txt", True), ("2.txt", False)]
    sinks.write_texts(sinks.export_texts(everything), f"file://{tmp_path}/texts")
    assert spark.read.text(f"file://{tmp_path}/texts").count() == 2
    sinks.append_rejects(spark.createDataFrame([("v", "1: bad")], S.REJECTS), f"file://{tmp_path}/rejects")
    sinks.append_rejects(spark.createDataFrame([("v", "2: bad")], S.REJECTS), f"file://{tmp_path}/rejects")
    assert spark.read.json(f"file://{tmp_path}/rejects").count() == 2
    files = spark.createDataFrame([("a", "h"), ("b", "h"), ("c", "k")], "path string, sha256 string")
    new, counts = sinks.content_addressed(files, spark.createDataFrame([("k",)], "sha256 string"))
    assert new.count() == 1 and tuple(counts.first()) == (1, 2)
    sinks.write_indexed(docs, "indexed_docs", ["id"], 2)
    assert sinks.table_sizes(spark, ["indexed_docs"]).first().n_rows == 3
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1")
    assert records.read_landing(spark, f"file://{tmp_path}/*.pdf").first().is_pdf


def test_stream_ingest(spark, tmp_path):
    src, out, ck = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck"
    src.mkdir()
    (src / "a.json").write_text('{"sha256": "a", "ok": true}\n{"sha256": "b", "ok": true}\n')
    ingest_new(spark, f"file://{src}", S.EXTRACTION_LOG, out, ck, "sha256")
    (src / "b.json").write_text('{"sha256": "b", "ok": false}\n{"sha256": "c", "ok": true}\n')
    ingest_new(spark, f"file://{src}", S.EXTRACTION_LOG, out, ck, "sha256")
    assert rows_of(spark.read.parquet(out), "sha256", "ok") == [("a", True), ("b", True), ("c", True)]


def test_quotes_in_bodies(spark, monkeypatch):
    """Long, short and one-word quotes, broadcast and shuffled, against a scan of every pair."""
    import random

    from marlstone.operators import evidence

    rng = random.Random(0)
    words = ["ab", "ba", "aab", "c", "bc", "abba"]
    bodies = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(80)]
    quotes = [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 7)))) for i in range(60)] + [(200, "b"), (201, "a c"), (202, bodies[3][1][1:-1] or "b")]
    want = sorted((k, d) for k, q in quotes for d, b in bodies if q in b)
    q, b = spark.createDataFrame(quotes, "k long, q string"), spark.createDataFrame(bodies, "d long, b string")
    for few, block in ((1 << 20, 500), (0, 7)):
        monkeypatch.setattr(evidence, "FEW_BYTES", few)
        monkeypatch.setattr(evidence, "SHORT_BLOCK", block)
        assert sorted(tuple(r) for r in evidence.containing(q, b, "k", "q", "d", "b").collect()) == want
    assert evidence.containing(q.limit(0), b, "k", "q", "d", "b").count() == 0


def test_small_tables_in_few_files_are_dealt(spark, tmp_path, monkeypatch):
    from marlstone import storage

    spark.range(1000).coalesce(1).write.parquet(f"file://{tmp_path}/one.parquet")
    assert storage.table(spark, f"file://{tmp_path}", "one").rdd.getNumPartitions() == 1  # too small to be worth it
    monkeypatch.setattr(storage, "DEAL_FROM", 1)
    rows = storage.table(spark, f"file://{tmp_path}", "one")
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in rows.collect()) == list(range(1000))
    monkeypatch.setattr(storage, "DEAL_UPTO", 0)
    assert storage.table(spark, f"file://{tmp_path}", "one").rdd.getNumPartitions() == 1


def test_common_hashes_make_no_candidates(spark, monkeypatch):
    """Sketches that share a third of their hashes with all others are not compared; the pairs are those of brute force, in any order of hashes."""
    import numpy as np

    rng = np.random.default_rng(3)
    common, made = rng.integers(-(1 << 62), 1 << 62, 90), []
    for i in range(120):
        size = 256 if i % 4 else int(rng.integers(5, 120))
        own = np.unique(np.concatenate([common[: size // 3], rng.integers(-(1 << 62), 1 << 62, size)]))[:size]
        made.append(own)
        if i % 3 == 0:  # copies on both sides of the threshold
            made += [np.unique(np.concatenate([rng.permutation(own)[: int(size * part)], rng.integers(-(1 << 62), 1 << 62, size - int(size * part))])) for part in (0.95, 0.85, 0.8)]
    rows = [(i, 200 + i % 50, s.tolist()) for i, s in enumerate(made)]
    want = set()
    for i, (_, n, x) in enumerate(rows):
        for j, (_, m, y) in enumerate(rows[:i]):
            window = sorted({*x, *y})[: neardup.SKETCH]
            if max(n, m) <= 1.4 * min(n, m) and len({*window} & {*x} & {*y}) / len(window) >= neardup.THRESHOLD:
                want.add((j, i))
    sketched = spark.createDataFrame(rows, "doc_id long, n_words int, sketch array<long>")
    assert len(want) > 20 and {(r.a, r.b) for r in neardup.similar_pairs(sketched).collect()} == want
    assert neardup.candidate_pairs(sketched).count() < 10 * len(want)
    for kept in (0, 7):  # no hash, or few, known to be frequent
        monkeypatch.setattr(neardup, "MOST_FREQUENT", kept)
        assert {(r.a, r.b) for r in neardup.similar_pairs(sketched).collect()} == want


def test_components_in_one_task(spark):
    """Few links are joined by one task with the same result as in rounds; more than ``few`` go in rounds."""
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(-300, 0)] + [(5000, 1000 + i) for i in range(300)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(7, 7), (1 << 62, -(1 << 62))]
    rng.shuffle(edges)
    links = spark.createDataFrame(edges, "u long, v long")
    want = rows_of(components.connected_components(links), "node", "component")
    assert len(want) == len(dict(want)) > 600
    assert sorted(rows_of(components.connected_components(links, few=10_000), "node", "component")) == sorted(want)
    assert sorted(rows_of(components.connected_components(links, few=100), "node", "component")) == sorted(want)
    assert components.connected_components(links.limit(0), few=100).count() == 0
