"""Deduplication and merging of record logs into documents and sections.

Order-dependent rules (first wins, last wins) go by an explicit ``seq`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import semester_code


def first_wins(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """One row per key, that with the smallest ``seq``: an aggregate, combined before the shuffle."""
    return _pick(rows, key, seq, F.min_by)


def last_wins(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    return _pick(rows, key, seq, F.max_by)


def _pick(rows: DataFrame, key: str, seq: str, by) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(by(F.struct(*rest), seq).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def ok_only(log: DataFrame) -> DataFrame:
    """Records whose ``ok`` is true; null is not."""
    return log.where(F.coalesce("ok", F.lit(False)))


def targets(manifest: DataFrame, kind: str) -> DataFrame:
    """doc_id and the first course that names it, for one kind of link."""
    rows = manifest.where((F.col("kind") == kind) & F.col("doc_id").isNotNull() & (F.col("doc_id") != ""))
    return rows.groupBy("doc_id").agg(F.min_by("course", "seq").alias("sample_course"))


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to do."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def exact_copies(docs: DataFrame, content: Column, key: str = "doc_id") -> DataFrame:
    """content_sha256 with the smallest key, all keys in order and their number."""
    hashed = docs.select(F.sha2(content, 256).alias("content_sha256"), F.col(key).alias("k"))
    return hashed.groupBy("content_sha256").agg(F.min("k").alias("first_id"), F.array_sort(F.collect_list("k")).alias("source_ids"), F.count("*").alias("copies"))


def exact_classes(docs: DataFrame, content: Column, key: str = "doc_id") -> DataFrame:
    """Each document's content_sha256 with the smallest key and the number of documents that share it; no group is gathered."""
    hashed = docs.select(F.col(key), F.sha2(content, 256).alias("content_sha256"))
    groups = hashed.groupBy("content_sha256").agg(F.min(key).alias("first_id"), F.count("*").alias("copies"))
    return hashed.join(groups, "content_sha256").select(key, "content_sha256", "first_id", "copies")


_PDF_FIRST, _PAGE_SECOND = 0, 1

# The kinds of sources and the tier of rendered pages.
PDF_KIND, PAGE_KIND, PAGE_TIER = "pdf", "simple_syllabus", "rendered_html"


def build_documents(pdf_log: DataFrame, page_log: DataFrame, extractions: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (one per content hash) and the map source_id to content_sha256.

    Files come before pages; the first record of a hash gives its attributes and every record
    adds its source id, in order. The last extraction of a hash counts, whatever its state.
    ``texts``: path and text; a text joins its document once the records are merged, so that
    bodies are in no aggregate.
    """
    last = last_wins(extractions, "sha256").select(F.col("sha256").alias("h"), "pages", "tier", F.col("chars").alias("ex_chars"), "chars_per_page", F.col("text_path").alias("ex_path"))
    pdf = ok_only(pdf_log).join(last, F.col("sha256") == F.col("h"), "left")
    null = F.lit(None).cast("string")
    files = pdf.select(
        "sha256", "doc_id", "seq", F.lit(_PDF_FIRST).alias("rank"), F.lit(PDF_KIND).alias("source_kind"), null.alias("source_url"), "original_filename", F.col("bytes").alias("byte_size"), F.col("pages").alias("page_count"), F.col("ex_path").alias("body_path"), F.col("tier").alias("extract_tier"), F.col("ex_chars").alias("chars"), F.col("chars_per_page").cast("decimal(12,1)").alias("chars_per_page"), null.alias("last_updated"), "fetched_at"
    )
    page = ok_only(page_log)
    none = F.lit(None).cast("int")
    pages = page.select(
        "sha256", "doc_id", "seq", F.lit(_PAGE_SECOND).alias("rank"), F.lit(PAGE_KIND).alias("source_kind"), F.col("url").alias("source_url"), null.alias("original_filename"), none.alias("byte_size"), none.alias("page_count"), F.col("text_path").alias("body_path"), F.lit(PAGE_TIER).alias("extract_tier"), "chars", F.lit(None).cast("decimal(12,1)").alias("chars_per_page"), "last_updated", "fetched_at"
    )
    rows = files.unionByName(pages).withColumn("at", F.struct("rank", "seq"))
    attributes = [c for c in files.columns if c not in ("sha256", "doc_id", "seq", "rank")]
    merged = rows.groupBy("sha256").agg(F.min_by(F.struct(*attributes), "at").alias("d"), F.transform(F.array_sort(F.collect_list(F.struct("at", "doc_id"))), lambda x: x["doc_id"]).alias("source_ids"))
    body = texts.select(F.col("path").alias("p"), "text")
    merged = merged.join(body, F.col("d.body_path") == F.col("p"), "left")
    documents = merged.select(F.col("sha256").alias("content_sha256"), "source_ids", *[F.col("text").alias("body") if a == "body_path" else F.col(f"d.{a}").alias(a) for a in attributes])
    by_source = rows.groupBy(F.col("doc_id").alias("source_id")).agg(F.max_by("sha256", "at").alias("content_sha256"))
    return documents, by_source


def build_sections(manifest: DataFrame, by_source: DataFrame, documents: DataFrame) -> DataFrame:
    """Manifest rows as sections with their document's id; ``unmatched`` marks links to what was not fetched."""
    ids = by_source.join(documents.select("content_sha256", F.col("id").alias("document_id")), "content_sha256").select("source_id", "document_id")
    rows = manifest.join(ids, F.col("doc_id") == F.col("source_id"), "left")
    return rows.select(
        semester_code(F.col("semester")).alias("semester_code"),
        F.col("semester").alias("semester_label"),
        F.trim("dept").alias("department"),
        F.col("course").alias("course_code"),
        F.col("unique").alias("unique_number"),
        F.col("title").alias("section_title"),
        F.col("instructors").alias("instructor"),
        F.nullif("cv", F.lit("")).alias("cv_url"),
        "document_id",
        ((F.coalesce("doc_id", F.lit("")) != "") & F.col("document_id").isNull()).alias("unmatched"),
    )


def syllabi(sections: DataFrame, documents: DataFrame) -> DataFrame:
    """Sections with the text of their document; sections without one are left out."""
    return sections.join(documents.withColumnRenamed("id", "document_id"), "document_id")


def summary_by_kind(manifest: DataFrame) -> DataFrame:
    """Sections and distinct targets of each kind of link."""
    return manifest.groupBy("kind").agg(F.count("*").alias("n_sections"), F.countDistinct("doc_id").alias("n_targets"))


def run_counters(log: DataFrame) -> DataFrame:
    """Counts of a fetch run: new content, duplicates, failures, bytes."""
    ok = F.coalesce("ok", F.lit(False))
    return log.agg(F.countDistinct(F.when(ok, F.col("sha256"))).alias("new"), F.count_if(ok).alias("fetched"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum(F.when(ok, F.col("bytes"))), F.lit(0)).alias("bytes")).select("new", (F.col("fetched") - F.col("new")).alias("duplicates"), "failed", "bytes")
