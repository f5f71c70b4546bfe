"""The commands, one after another, on a small store."""

import json

import pytest

from marlstone.__main__ import main


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("commands")
    src = root / "records"
    body = " ".join(f"word{i % 37}x phones are not permitted in class number{i}" .replace(str(i), "abcdefghij"[i % 10]) for i in range(60))
    (src / "text").mkdir(parents=True)
    for name, text in (("a", body), ("b", body + " one more"), ("c", "short syllabus. AI tools must be cited.")):
        (src / "text" / f"{name}.txt").write_text(text)
    write(src / "fetch_log.jsonl", [{"doc_id": "1", "ok": True, "sha256": "a", "bytes": 10}, {"doc_id": "2", "ok": True, "sha256": "b", "bytes": 11}, {"doc_id": "9", "ok": False, "sha256": "x"}])
    write(src / "page_log.jsonl", [{"doc_id": "p1", "ok": True, "sha256": "c", "url": "u", "chars": 20, "text_path": "text/c.txt"}])
    write(src / "extraction_log.jsonl", [{"sha256": s, "pages": 1, "tier": "text_layer", "chars": 100, "chars_per_page": 100.0, "text_path": f"text/{s}.txt", "ok": True} for s in "ab"])
    links = [("100", "1"), ("101", "2"), ("102", "p1"), ("103", "9"), ("104", "")]
    write(src / "manifest.jsonl", [{"semester": "2026 Fall", "course": "C 1", "unique": u, "title": "t", "instructors": f"i{u}", "cv": "", "dept": "HIS", "kind": "download_pdf", "doc_id": d} for u, d in links])
    assert main(["--store", f"file://{root}/store", "load-database", f"file://{src}"], spark) == 0
    return root


def url(store):
    return f"file://{store}/store"


def coded(i, quote, **more):
    row = {"document_id": i, "document_completeness": "full", "coder_notes": ""}
    for s in ("phone", "laptop", "ai"):
        row |= {f"{s}_score": 0, f"{s}_label": "not addressed", f"{s}_status": "clear", f"{s}_confidence": "high", f"{s}_required": False, f"{s}_evidence": None}
    return row | {"phone_score": 5, "phone_label": "prohibited", "phone_evidence": quote} | more


def test_load_is_idempotent(spark, store, capsys):
    docs = spark.read.parquet(f"{url(store)}/documents")
    assert {r.content_sha256: (r.id, r.source_kind) for r in docs.collect()} == {"a": (1, "pdf"), "b": (2, "pdf"), "c": (3, "simple_syllabus")}
    sections = spark.read.parquet(f"{url(store)}/sections")
    assert {r.unique_number: r.document_id for r in sections.collect()} == {"100": 1, "101": 2, "102": 3, "103": None, "104": None}
    assert sections.select("id").distinct().count() == 5
    assert main(["--store", url(store), "load-database", f"file://{store}/records"], spark) == 0
    said = capsys.readouterr().out
    assert "documents: 3 unchanged" in said and "sections: 5 unchanged" in said and "not fetched: 1" in said


def test_coding(spark, store, capsys):
    (store / "coded").mkdir()
    (store / "coded" / "batch_1.json").write_text(json.dumps([coded(1, "phones are not permitted"), coded(2, ["phones are NOT permitted in class"]), coded(2, "phones"), coded(77, "x"), coded(3, "no such quote at all")]))
    (store / "coded" / "batch_2.json").write_text('[{"document_id": 3')
    assert main(["--store", url(store), "load-classifications", f"file://{store}/coded", "v7-full"], spark) == 0
    said = capsys.readouterr().out
    assert "skipped batch_2.json" in said and "document_policies: 2 inserted" in said and "refused: 3" in said
    problems = {r.problem for r in spark.read.json(f"{url(store)}/rejects").collect()}
    assert problems == {"2: duplicate record", "77: not a document we asked for", "3: phone evidence not found in document"}
    assert main(["--store", url(store), "verify-evidence"], spark) == 0
    assert main(["--store", url(store), "analyze-policies"], spark) == 0
    assert main(["--store", url(store), "analyze-policies", "v1"], spark) == 1
    (store / "second").mkdir()
    (store / "second" / "batch_1.json").write_text(json.dumps([coded(1, "phones", phone_score=4, phone_label="restricted")]))
    capsys.readouterr()
    assert main(["--store", url(store), "coder-agreement", "v7-full", f"file://{store}/second"], spark) == 0
    assert "phone\t1\t0\t1" in capsys.readouterr().out
    assert main(["--store", url(store), "coder-agreement"], spark) == 1


def test_export_and_groups(spark, store, capsys):
    assert main(["--store", url(store), "export-for-coding", f"file://{store}/out", "all"], spark) == 0
    assert "exported 3, of them changed since the last export 0" in capsys.readouterr().out
    assert main(["--store", url(store), "find-near-duplicates", "--write"], spark) == 0
    groups = {r.id: r.near_duplicate_group for r in spark.read.parquet(f"{url(store)}/documents").collect()}
    assert groups == {1: "nd1", 2: "nd1", 3: None}
    assert main(["--store", url(store), "search", '"phones are" or cited'], spark) == 0
    said = capsys.readouterr().out
    assert "documents: 3" in said and "HIS\t3" in said


def test_manifest(spark, tmp_path, capsys):
    cells = "".join(f"<td>{c}</td>" for c in ("", "C 1", "100", "t", "i", "cv")) + '<td><a href="/download/12/">s</a></td><td></td>'
    write(tmp_path / "pages.jsonl", [{"dept": "HIS", "html": f'<table id="results_table"><tbody><tr>{cells}</tr></tbody></table> Limiting results'}])
    assert main(["build-manifest", f"file://{tmp_path}/pages.jsonl", f"file://{tmp_path}/out", "2025", "spring"], spark) == 0
    row = spark.read.json(f"file://{tmp_path}/out").first()
    assert (row.doc_id, row.semester, row.kind) == ("12", "2025 Spring", "download_pdf") and "cut: HIS" in capsys.readouterr().out
    assert main(["build-manifest", f"file://{tmp_path}/pages.jsonl", f"file://{tmp_path}/out", "2025", "autumn"], spark) == 1
