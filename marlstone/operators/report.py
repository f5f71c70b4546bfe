"""Distributions of scores; every share names its denominator.

Input in long form, one row for each document and scale: document_id, completeness, scale,
score, status, required; and sections: document_id, instructor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.text import pct

# The strict and the permissive end of the scale, and the bins.
STRICT, LOOSE, MIDDLE, BINS = (4, 5), (1, 2), 3, range(6)


def long_form(policies: DataFrame, scales: tuple[str, ...]) -> DataFrame:
    """Score rows of the wide table, one for each scale."""
    parts = F.explode(F.array(*[F.struct(F.lit(s).alias("scale"), F.col(f"{s}_score").alias("score"), F.col(f"{s}_status").alias("status"), F.col(f"{s}_required").alias("required")) for s in scales]))
    return policies.select("document_id", F.col("document_completeness").alias("completeness"), parts.alias("p")).select("document_id", "completeness", "p.*")


def full() -> Column:
    """Coded as full; null is not."""
    return F.col("completeness").eqNullSafe("full")


def clear() -> Column:
    return full() & F.col("status").eqNullSafe("clear")


def sections_per_document(sections: DataFrame) -> DataFrame:
    return sections.where(F.col("document_id").isNotNull()).groupBy("document_id").agg(F.count("*").alias("n_sections"))


def with_sections(scores: DataFrame, sections: DataFrame) -> DataFrame:
    """Scores with n_sections, 0 where a document has none; sections are counted before the join."""
    return scores.join(sections_per_document(sections), "document_id", "left").fillna(0, ["n_sections"])


def instructors_of(scores: DataFrame, sections: DataFrame) -> DataFrame:
    """document_id, instructor: distinct pairs of scored documents. An empty name is one, null is none."""
    pairs = sections.where(F.col("instructor").isNotNull() & F.col("document_id").isNotNull()).select("document_id", "instructor").distinct()
    return pairs.join(scores.select("document_id").distinct(), "document_id", "left_semi")


def totals(scores: DataFrame, sections: DataFrame) -> DataFrame:
    """Documents, sections and instructors over all rows, stubs included."""
    docs = scores.select("document_id").distinct()
    counted = docs.join(sections_per_document(sections), "document_id", "left")
    a = counted.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n_sections"), F.lit(0)).alias("sections"))
    b = instructors_of(scores, sections).agg(F.countDistinct("instructor").alias("instructors"))
    return a.crossJoin(b)


def _scaffold(scores: DataFrame, bins: range = BINS) -> DataFrame:
    """Every scale with every bin, so that empty bins show."""
    return scores.select("scale").distinct().select("scale", F.explode(F.array(*[F.lit(b) for b in bins])).alias("score"))


def bin_distribution(scores: DataFrame, sections: DataFrame) -> DataFrame:
    """scale, score, denominator, n, total, pct under three denominators.

    documents: of the clear ones. sections: of those of all documents. instructors: distinct
    names of clear documents in the bin, of all names; they can count in several bins.
    """
    rows = with_sections(scores, sections)
    hits = rows.where(clear()).groupBy("scale", "score").agg(F.count("*").alias("documents"), F.sum("n_sections").alias("sections"))
    names = rows.where(clear()).select("scale", "score", "document_id").join(instructors_of(scores, sections), "document_id")
    names = names.groupBy("scale", "score").agg(F.countDistinct("instructor").alias("instructors"))
    filled = _scaffold(scores).join(hits, ["scale", "score"], "left").join(names, ["scale", "score"], "left").fillna(0, ["documents", "sections", "instructors"])
    base = rows.groupBy("scale").agg(F.count_if(clear()).alias("all_documents"), F.sum("n_sections").alias("all_sections"))
    filled = filled.join(F.broadcast(base), "scale").crossJoin(F.broadcast(totals(scores, sections).select(F.col("instructors").alias("all_instructors"))))
    parts = F.explode(F.array(*[F.struct(F.lit(d).alias("denominator"), F.col(d).alias("n"), F.col(f"all_{d}").alias("total")) for d in ("documents", "sections", "instructors")]))
    return filled.select("scale", "score", parts.alias("p")).select("scale", "score", "p.*", pct(F.col("p.n"), F.col("p.total")).alias("pct"))


def status_counts(scores: DataFrame) -> DataFrame:
    """Per scale: coded in full, clear, unclear and the unclear share of full."""
    rows = scores.groupBy("scale").agg(F.count_if(full()).alias("full"), F.count_if(clear()).alias("clear"), F.count_if(full() & F.col("status").isin("undecided", "contradictory")).alias("unclear"))
    return rows.select("*", pct(F.col("unclear"), F.col("full")).alias("unclear_pct"))


def addressed_shares(scores: DataFrame, sections: DataFrame) -> DataFrame:
    """Per scale: addressed documents and sections, and the strict, middle and permissive shares of addressed."""
    rows, hit = with_sections(scores, sections), clear() & (F.col("score") > 0)
    out = rows.groupBy("scale").agg(
        F.count_if(clear()).alias("clear"),
        F.count_if(hit).alias("addressed"),
        F.coalesce(F.sum(F.when(hit, F.col("n_sections"))), F.lit(0)).alias("addressed_sections"),
        F.sum("n_sections").alias("all_sections"),
        F.count_if(hit & F.col("score").isin(*STRICT)).alias("strict"),
        F.count_if(hit & (F.col("score") == MIDDLE)).alias("middle"),
        F.count_if(hit & F.col("score").isin(*LOOSE)).alias("permissive"),
    )
    return out.select("*", pct(F.col("addressed"), F.col("clear")).alias("addressed_pct"), pct(F.col("addressed_sections"), F.col("all_sections")).alias("section_pct"), *[pct(F.col(c), F.col("addressed")).alias(f"{c}_pct") for c in ("strict", "middle", "permissive")])


def required_share(scores: DataFrame, sections: DataFrame) -> DataFrame:
    """Per scale: documents that require, of those coded in full with any status, and their sections of all."""
    rows, hit = with_sections(scores, sections), full() & F.coalesce("required", F.lit(False))
    out = rows.groupBy("scale").agg(F.count_if(full()).alias("full"), F.count_if(hit).alias("required"), F.coalesce(F.sum(F.when(hit, F.col("n_sections"))), F.lit(0)).alias("required_sections"), F.sum("n_sections").alias("all_sections"))
    return out.select("*", pct(F.col("required"), F.col("full")).alias("required_pct"), pct(F.col("required_sections"), F.col("all_sections")).alias("section_pct"))


def class_policy_groups(scores: DataFrame, sections: DataFrame, scale: str) -> DataFrame:
    """Distinct (instructor, course, score, status, required) of one scale, counted by score: groups, and strict ones."""
    rows = scores.where(F.col("scale") == scale).select("document_id", "score", "status", "required")
    held = sections.where(F.col("instructor").isNotNull()).select("document_id", "instructor", "course").join(rows, "document_id")
    groups = held.select("instructor", "course", "score", "status", "required").distinct()
    return groups.groupBy("score").agg(F.count("*").alias("n_groups"), F.count_if(F.col("status") == "clear").alias("n_clear"))


def strict_share(scores: DataFrame, require_full: bool = False) -> DataFrame:
    """Per scale: strict of addressed among clear rows; ``require_full`` also leaves out stubs."""
    rows = scores.where(F.col("status") == "clear")
    rows = rows.where(full()) if require_full else rows
    out = rows.groupBy("scale").agg(F.count_if(F.col("score") >= 4).alias("strict"), F.count_if(F.col("score") > 0).alias("addressed"))
    return out.select("*", pct(F.col("strict"), F.col("addressed")).alias("strict_pct"))


def contested_band(scores: DataFrame, contested: DataFrame) -> DataFrame:
    """Strict share as coded, with contested documents all at the middle (low), and all strict (high)."""
    rows = scores.where(clear() & (F.col("score") > 0)).join(contested.select("document_id").distinct().withColumn("c", F.lit(True)), "document_id", "left")
    in_doubt = F.coalesce("c", F.lit(False))
    strict = F.col("score") >= 4
    out = rows.groupBy("scale").agg(F.count("*").alias("addressed"), F.count_if(in_doubt).alias("contested"), F.count_if(strict & ~in_doubt).alias("low"), F.count_if(strict).alias("coded"), F.count_if(strict | in_doubt).alias("high"))
    return out.select("*", *[pct(F.col(c), F.col("addressed")).alias(f"{c}_pct") for c in ("low", "coded", "high")])


def crosstab(rows: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts of ``row`` by the given values of ``column``; absent cells are 0."""
    named = rows.groupBy(row).pivot(column, values).agg(F.count(F.lit(1)))
    return named.fillna(0, [c for c in named.columns if c != row])


def overlay(base: DataFrame, over: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows of ``over`` where a document has one, else of ``base``."""
    both = base.withColumn("_p", F.lit(1)).unionByName(over.withColumn("_p", F.lit(0)))
    first = F.row_number().over(Window.partitionBy(key, "scale").orderBy("_p")) if "scale" in base.columns else F.row_number().over(Window.partitionBy(key).orderBy("_p"))
    return both.withColumn("_n", first).where("_n = 1").drop("_n", "_p")


def collapse(documents: DataFrame, groups: DataFrame) -> DataFrame:
    """Documents with ``unit``: the group of near-duplicates where they have one, else themselves."""
    return documents.join(groups, "document_id", "left").withColumn("unit", F.coalesce("near_duplicate_group", F.col("document_id").cast("string")))
