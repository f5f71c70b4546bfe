"""Commands over a store: a folder of Parquet tables (documents, sections, document_policies) and a rejection log.

    python -m marlstone --store PATH load-database RECORDS
    python -m marlstone --store PATH export-for-coding OUT [dev|gold|all]
    python -m marlstone --store PATH load-classifications DIR VERSION [--batches DIR]
    python -m marlstone --store PATH verify-evidence [VERSION]
    python -m marlstone --store PATH coder-agreement [FIRST] [SECOND]
    python -m marlstone --store PATH find-near-duplicates [--write]
    python -m marlstone --store PATH analyze-policies [VERSION]
    python -m marlstone --store PATH search QUERY
    python -m marlstone build-manifest PAGES OUT [YEAR] [SEMESTER]

Commands return 0, or 1 where there is nothing to report on or a check fails. Collecting pages
and files is not part of them: they read what was collected.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone import schemas as S
from marlstone.functions.text import SEMESTERS, quotes_of_variant
from marlstone.operators import agreement, evidence, exports, merge, neardup, report, search, upsert, validate
from marlstone.sources import pages, records, sinks
from marlstone.storage import materialize

# What commands take where nothing is named.
VERSION, SECOND, YEAR, SEMESTER = "v7-full", "v7-second", 2026, "fall"


def _table(spark: SparkSession, store: str, name: str, schema: T.StructType) -> DataFrame:
    path = f"{store}/{name}"
    return spark.read.parquet(path) if records.exists(spark, path) else spark.createDataFrame([], schema)


def _documents(spark: SparkSession, store: str) -> DataFrame:
    return _table(spark, store, "documents", S.DOCUMENTS)


def _put(rows: DataFrame, store: str, name: str) -> None:
    """Swap in an upsert's result and say what changed."""
    done = materialize(rows, f"new-{name}")
    counts = {r[upsert.CHANGE]: r["count"] for r in done.groupBy(upsert.CHANGE).count().collect()}
    sinks.swap(done.drop(upsert.CHANGE), f"{store}/{name}")
    print(f"{name}: " + (", ".join(f"{n} {k}" for k, n in sorted(counts.items())) or "no rows"))


def _show(rows: DataFrame, n: int = 100) -> None:
    print("\t".join(rows.columns))
    for r in rows.limit(n).collect():
        print("\t".join("" if v is None else f"{v:.1f}" if isinstance(v, float) else str(v) for v in r))


def build_manifest(spark: SparkSession, source: str, out: str, year: int = YEAR, semester: str = SEMESTER) -> int:
    """Listing pages (JSON lines of dept and html) to manifest records."""
    if semester.lower() not in SEMESTERS:
        print(f"no such semester: {semester}; known are {', '.join(SEMESTERS)}", file=sys.stderr)
        return 1
    listed = records.read_jsonl(spark, source, T.StructType([T.StructField("dept", T.StringType()), T.StructField("html", T.StringType())]))
    rows = materialize(pages.listing_rows(listed), "manifest")
    sinks.write_jsonl(rows.withColumn("semester", F.coalesce(F.nullif("semester", F.lit("")), F.lit(f"{year} {semester.title()}"))), out)
    _show(merge.summary_by_kind(rows))
    cut = listed.where(pages.is_cut(F.col("html"))).select("dept")
    for r in cut.collect():
        print(f"cut: {r.dept}")
    return 0


def load_database(spark: SparkSession, store: str, source: str) -> int:
    """Manifest, logs and texts of a folder into documents and sections; running it again changes nothing."""

    def log(name: str, schema: T.StructType) -> DataFrame:
        return records.with_sequence(records.read_jsonl(spark, f"{source}/{name}.jsonl", schema))

    texts = records.read_texts(spark, f"{source}/text/*.txt").withColumn("path", F.element_at(F.split("path", "/"), -1)) if records.exists(spark, f"{source}/text/*.txt") else spark.createDataFrame([], "path string, text string")

    def by_file(rows: DataFrame) -> DataFrame:
        return rows.withColumn("text_path", F.element_at(F.split("text_path", "/"), -1))

    found, by_source = merge.build_documents(log("fetch_log", S.FETCH_LOG), by_file(log("page_log", S.PAGE_LOG)), by_file(log("extraction_log", S.EXTRACTION_LOG)), texts)
    _put(upsert.upsert_documents(_documents(spark, store), found), store, "documents")
    manifest = records.read_jsonl(spark, f"{source}/manifest.jsonl", S.MANIFEST)
    built = materialize(merge.build_sections(manifest, by_source, _documents(spark, store)), "sections")
    unmatched = built.where("unmatched").count()
    staged = built.drop("unmatched").dropDuplicates(upsert.SECTION_KEY)
    rows = upsert.upsert_sections(_table(spark, store, "sections", S.SECTIONS), staged).withColumn("_key", F.concat_ws("-", *upsert.SECTION_KEY))
    _put(upsert.with_ids(rows, "_key").drop("_key"), store, "sections")
    print(f"links to documents that were not fetched: {unmatched}")
    return 0


def export_for_coding(spark: SparkSession, store: str, out: str, split: str = "dev") -> int:
    sample = _table(spark, store, "policy_sample", S.POLICY_SAMPLE)
    rows = exports.selected(_documents(spark, store), sample, split)
    before = records.read_texts(spark, f"{out}/file=*/*") if records.exists(spark, f"{out}/file=*") else None
    if before is not None:
        before = before.select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("file"), "text")
    made = materialize(sinks.export_texts(rows, before), "export")
    sinks.write_texts(made, out)
    print(f"exported {made.count()}, of them changed since the last export {made.where('stale').count()}")
    return 0


def _coded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Files of a coder's folder and their records in order, quotes as arrays whatever they came as."""
    files = records.read_json_folder(spark, f"{folder}/*.json")
    rows = records.records_of(files, S.CODER_RECORD)
    for s in S.SCALES:
        rows = rows.withColumn(f"{s}_evidence", quotes_of_variant(F.try_variant_get("rec", f"$.{s}_evidence", "variant")))
    return files, records.with_sequence(rows.drop("rec"), ["file", "place"])


def load_classifications(spark: SparkSession, store: str, folder: str, version: str, batches: str | None = None) -> int:
    """Coded batches into document_policies; what is refused goes to the rejection log."""
    files, rows = _coded(spark, folder)
    docs = _documents(spark, store).select("id", "body")
    wanted = spark.createDataFrame([], "file string, document_id long")
    if batches:
        spec = records.read_json_folder(spark, f"{batches}/*.json").where("valid")
        items = spec.select("file", F.explode(F.try_variant_get("data", "$", "array<variant>")).alias("v"))
        wanted = items.select("file", F.coalesce(F.try_variant_get("v", "$.document_id", "bigint"), F.try_variant_get("v", "$", "bigint")).alias("document_id"))
    gated = materialize(validate.batch_gate(files.select("file", "valid", "n_records"), wanted, validate.quarantined_ids(docs)), "batches")
    for r in gated.where("reason is not null").collect():
        print(f"skipped {r.file}: {r.reason}")
    rows = rows.join(gated.where("reason is null").select("file"), "file", "left_semi")
    checked = materialize(validate.check(rows, docs), "checked")
    sinks.append_rejects(validate.to_rejects(checked, version), f"{store}/rejects")
    _put(upsert.upsert_policies(_table(spark, store, "document_policies", S.POLICIES), validate.to_policies(checked, version)), store, "document_policies")
    print(f"refused: {checked.where('reason is not null').count()}")
    return 0


def _policies(spark: SparkSession, store: str, version: str) -> DataFrame:
    return records.of_version(_table(spark, store, "document_policies", S.POLICIES), version)


def verify_evidence(spark: SparkSession, store: str, version: str = VERSION) -> int:
    counts, missing = evidence.audit(_policies(spark, store, version), _documents(spark, store).select("id", "body"), S.SCALES)
    counts = materialize(counts, "audit")
    _show(counts)
    _show(missing.orderBy("document_id", "scale"))
    return int(counts.first().not_found > 0)


def coder_agreement(spark: SparkSession, store: str, first: str = VERSION, second: str = SECOND) -> int:
    """Two codebook versions, or folders of coded records, on the documents they share."""

    def scored(name: str) -> DataFrame:
        if "/" in name:
            rows = records.last_file_wins(_coded(spark, name)[1])
        else:
            rows = _policies(spark, store, name)
        return report.long_form(rows, S.SCALES)

    pairs = materialize(agreement.paired(scored(first), scored(second)), "pairs")
    if not pairs.limit(1).count():
        print("no document was coded by both", file=sys.stderr)
        return 1
    _show(agreement.rates(pairs).join(agreement.alpha_ordinal(pairs), "scale").orderBy("scale"))
    _show(agreement.wide(pairs).orderBy("document_id", "scale"))
    return 0


def find_near_duplicates(spark: SparkSession, store: str, write: bool = False) -> int:
    docs = _documents(spark, store)
    texts = docs.select(F.col("id").alias("doc_id"), F.col("body").alias("text"))
    found = materialize(neardup.clusters(*neardup.linked(texts)), "clusters")
    _show(neardup.statistics(texts, found))
    _show(neardup.largest(found))
    if write:
        sinks.swap(materialize(neardup.write_back(docs, found), "grouped"), f"{store}/documents")
    return 0


def analyze_policies(spark: SparkSession, store: str, version: str = VERSION) -> int:
    scores = materialize(report.long_form(_policies(spark, store, version), S.SCALES), "scores")
    if not scores.limit(1).count():
        print(f"no rows of version {version}", file=sys.stderr)
        return 1
    held = _table(spark, store, "sections", S.SECTIONS).select("document_id", "instructor")
    for rows in (report.totals(scores, held), report.bin_distribution(scores, held).orderBy("scale", "denominator", "score"), report.status_counts(scores), report.addressed_shares(scores, held), report.required_share(scores, held)):
        _show(rows)
    return 0


def search_texts(spark: SparkSession, store: str, query: str) -> int:
    """Documents that match a web-search query, and their sections by department."""
    posted = search.stored(_documents(spark, store), "id", "body", "english")
    found = materialize(search.search(posted, query, "english"), "found")
    print(f"documents: {found.count()}")
    _show(search.rollup(found, _table(spark, store, "sections", S.SECTIONS).select("document_id", "department")))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marlstone", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--store")
    sub = top.add_subparsers(dest="command", required=True)
    for name, *rest in (
        ("build-manifest", "source", "out", ("year", int, YEAR), ("semester", str, SEMESTER)),
        ("load-database", "source"),
        ("export-for-coding", "out", ("split", str, "dev")),
        ("load-classifications", "folder", "version"),
        ("verify-evidence", ("version", str, VERSION)),
        ("coder-agreement", ("first", str, VERSION), ("second", str, SECOND)),
        ("find-near-duplicates",),
        ("analyze-policies", ("version", str, VERSION)),
        ("search", "query"),
    ):
        one = sub.add_parser(name)
        for r in rest:
            if isinstance(r, str):
                one.add_argument(r)
            else:
                one.add_argument(r[0], nargs="?", type=r[1], default=r[2])
        if name == "load-classifications":
            one.add_argument("--batches")
        if name == "find-near-duplicates":
            one.add_argument("--write", action="store_true")
    return top


_RUN = {"build-manifest": build_manifest, "load-database": load_database, "export-for-coding": export_for_coding, "load-classifications": load_classifications, "verify-evidence": verify_evidence, "coder-agreement": coder_agreement, "find-near-duplicates": find_near_duplicates, "analyze-policies": analyze_policies, "search": search_texts}


def main(args: list[str], spark: SparkSession | None = None) -> int:
    given = vars(parser().parse_args(args))
    command, store = given.pop("command"), given.pop("store")
    if command != "build-manifest":
        if not store:
            parser().error(f"{command} needs --store")
        given = {"store": store.rstrip("/"), **given}
    if spark is None:
        from marlstone.session import build_session

        spark = build_session()
    return _RUN[command](spark, **given)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
