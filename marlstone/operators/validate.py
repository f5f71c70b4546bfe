"""Validation of coded records: the first rule that fails is the reason a record is refused."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.text import as_quotes
from marlstone.operators.evidence import FUZZY, MISSING, match

# Labels by score, and the domains of the other fields.
DEVICE_LABELS = ["not addressed", "required", "permitted", "discouraged", "restricted", "prohibited"]
AI_LABELS = ["not addressed", "required", "permitted", "conditional", "restricted", "prohibited"]
LABELS = {"phone": DEVICE_LABELS, "laptop": DEVICE_LABELS, "ai": AI_LABELS}
CONFIDENCE, COMPLETENESS, STATUSES = ["high", "medium", "low"], ["full", "stub"], ["clear", "undecided", "contradictory"]

# Wordings that readers of the rejection log know.
NOT_ASKED = "not a document we asked for"
QUARANTINED = "quarantined or empty document, refusing to score"
DUPLICATE = "duplicate record"
NOT_JSON = "not valid JSON yet (still being written)"
SOFT_NOTE = ": matched after normalizing extraction noise"


def _clean(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def scale_rules(scale: str) -> list[tuple[str, Column]]:
    """(reason, failed) of a scale's rules in order; ``<scale>_missing`` is the first quote not found."""
    status, score, label = _clean(F.col(f"{scale}_status")), F.col(f"{scale}_score"), _clean(F.col(f"{scale}_label"))
    n = F.size(as_quotes(F.col(f"{scale}_evidence")))
    known = score.isNotNull() & score.between(0, 5)
    wanted = F.try_element_at(F.array(*[F.lit(x) for x in LABELS[scale]]), F.when(known, score + 1).otherwise(1).cast("int"))
    clear = status == "clear"
    return [
        (f"{scale} status invalid", ~status.isin(STATUSES)),
        (f"{scale} score not 0-5", ~known),
        (f"{scale} label does not match score", label != wanted),
        (f"{scale} confidence invalid", ~_clean(F.col(f"{scale}_confidence")).isin(CONFIDENCE)),
        (f"{scale} required must be true/false", F.col(f"{scale}_required").isNull()),
        (f"{scale} scored 0 and clear, but has evidence", (score == 0) & clear & (n > 0)),
        (f"{scale} unsettled but cites nothing", (score == 0) & ~clear & (n == 0)),
        (f"{scale} scored with no evidence", (score > 0) & (n == 0)),
        (f"{scale} evidence not found in document", (score > 0) & F.col(f"{scale}_missing").isNotNull()),
    ]


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The first reason whose rule fails; null when none does."""
    return F.coalesce(*[F.when(failed, F.lit(reason)) for reason, failed in rules])


def document_rules() -> list[tuple[str, Column]]:
    """Rules before the scales': ``_matched`` tells a missing document from one without text."""
    return [
        (NOT_ASKED, F.col("_matched").isNull()),
        (QUARANTINED, F.coalesce(F.col("body"), F.lit("")) == ""),
        ("document_completeness not full/stub", ~_clean(F.col("document_completeness")).isin(COMPLETENESS)),
    ]


def check(records: DataFrame, documents: DataFrame) -> DataFrame:
    """``records`` (document_id, seq, coder fields) with ``reason`` and ``evidence_notes``.

    Of several valid records of a document the first loads; the later ones, valid or not, are
    duplicates.
    """
    bodies = documents.select(F.col("id").alias("document_id"), "body")
    spots = F.explode(F.array(*[F.struct(F.lit(s).alias("scale"), as_quotes(F.col(f"{s}_evidence")).alias("quotes")) for s in LABELS]))
    quotes = records.select("document_id", "seq", spots.alias("e")).select("document_id", "seq", "e.scale", F.posexplode("e.quotes").alias("at", "quote"))
    matched = match(quotes, bodies)
    missing = [F.min(F.when((F.col("how") == MISSING) & (F.col("scale") == s), F.struct("at", "quote")))["quote"].alias(f"{s}_missing") for s in LABELS]
    # A note for each fuzzy quote of a scored scale, in the order of scales and quotes.
    soft = F.array_sort(F.collect_list(F.when(F.col("how") == FUZZY, F.struct(F.array_position(F.array(*[F.lit(s) for s in LABELS]), F.col("scale")).alias("i"), "at", "scale")))).alias("_soft")
    found = matched.groupBy("document_id", "seq").agg(*missing, soft)
    rows = records.join(found, ["document_id", "seq"], "left").join(bodies.withColumn("_matched", F.lit(True)), "document_id", "left")
    rules = document_rules() + reduce(lambda a, b: a + b, [scale_rules(s) for s in LABELS])
    rows = rows.withColumn("_own", first_reason(rules))
    earlier = Window.partitionBy("document_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max(F.col("_own").isNull()).over(earlier), F.lit(False))
    scored = F.filter("_soft", lambda x: reduce(lambda a, s: a | ((x["scale"] == s) & (F.col(f"{s}_score") > 0)), LABELS, F.lit(False)))
    notes = F.transform(scored, lambda x: F.concat(x["scale"], F.lit(SOFT_NOTE)))
    rows = rows.withColumn("reason", F.when(seen, F.lit(DUPLICATE)).otherwise(F.col("_own")))
    rows = rows.withColumn("evidence_notes", F.nullif(F.array_join(notes, "; "), F.lit("")))
    return rows.drop("body", "_matched", "_own", "_soft", *[f"{s}_missing" for s in LABELS])


def to_policies(checked: DataFrame, version: str, model: str = "subagent") -> DataFrame:
    """Accepted records as score rows: cleaned fields, evidence joined by blank lines."""
    rows = checked.where(F.col("reason").isNull())
    out = [F.col("document_id"), _clean(F.col("document_completeness")).alias("document_completeness"), F.col("coder_notes")]
    for s in LABELS:
        quotes = as_quotes(F.col(f"{s}_evidence"))
        out += [
            F.col(f"{s}_score"),
            _clean(F.col(f"{s}_label")).alias(f"{s}_label"),
            F.when(F.size(quotes) > 0, F.array_join(quotes, "\n\n")).alias(f"{s}_evidence"),
            _clean(F.col(f"{s}_confidence")).alias(f"{s}_confidence"),
            F.col(f"{s}_required"),
            _clean(F.col(f"{s}_status")).alias(f"{s}_status"),
        ]
    return rows.select(*out, "evidence_notes", F.lit(version).alias("prompt_version"), F.lit(model).alias("model"))


def to_rejects(checked: DataFrame, version: str) -> DataFrame:
    problem = F.concat(F.coalesce(F.col("document_id").cast("string"), F.lit("null")), F.lit(": "), F.col("reason"))
    return checked.where(F.col("reason").isNotNull()).select(F.lit(version).alias("version"), problem.alias("problem"))


def batch_gate(files: DataFrame, wanted: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Files (file, valid, n_records) with expected and ``reason``; null reason: the file counts.

    ``wanted``: file and document_id of the batch definitions; a file without one is accepted.
    Quarantined documents are not expected.
    """
    held = quarantined.select("document_id").distinct().withColumn("_held", F.lit(1))
    expected = wanted.select("file", "document_id").distinct().join(held, "document_id", "left").groupBy("file").agg(F.count_if(F.col("_held").isNull()).alias("expected"))
    rows = files.join(expected, "file", "left")
    short = F.concat(F.col("n_records").cast("string"), F.lit(" of "), F.col("expected").cast("string"), F.lit(" records - incomplete"))
    return rows.withColumn("reason", F.when(~F.col("valid"), F.lit(NOT_JSON)).when(F.col("n_records") < F.col("expected"), short))


def quarantined_ids(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("body").isNull()).select(F.col("id").alias("document_id"))
