"""Which text of a document counts: text layer, recognized text, or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import MIN_CHARS_PER_PAGE, common_word_rate, looks_like_words, strip

ERROR_CHARS = 200


def chars_per_page(text: Column, pages: Column) -> Column:
    return F.length(strip(text)) / F.greatest(pages, F.lit(1))


def extraction(rows: DataFrame, text: str = "text", pages: str = "pages", ocr: str | None = None, encrypted: str | None = None, error: str | None = None) -> DataFrame:
    """``rows`` with tier, garbled_text_layer, chars, chars_per_page, ok and error.

    A text layer is used if it is dense and reads as words; else recognized text (column
    ``ocr``, null where recognition failed) takes its place. Locked files are ``encrypted``.
    """
    layer = F.coalesce(F.col(text), F.lit(""))
    # The costly measures are columns, so that each is taken once however many decisions read it.
    rows_ = rows.withColumns({"_rate": common_word_rate(layer), "_layer_chars": F.length(strip(layer))})
    dense = F.col("_layer_chars") / F.greatest(F.col(pages), F.lit(1)) >= MIN_CHARS_PER_PAGE
    usable = dense & looks_like_words(layer, F.col("_rate"))
    locked = F.coalesce(F.col(encrypted), F.lit(False)) if encrypted else F.lit(False)
    other = F.col(ocr) if ocr else F.lit(None).cast("string")
    tier = F.when(locked, "encrypted").when(usable, "text_layer").when(other.isNotNull(), "ocr").otherwise("failed")
    out = rows_.withColumn("tier", tier)
    chars = F.when(F.col("tier") == "text_layer", F.col("_layer_chars")).when(F.col("tier") == "ocr", F.length(strip(other)))
    fault = F.when(F.col("tier").isin("encrypted", "failed"), F.substring(F.col(error), 1, ERROR_CHARS) if error else F.lit(None).cast("string"))
    return (
        out.withColumn("garbled_text_layer", ~locked & dense & ~usable)
        .withColumn("chars", chars.cast("int"))
        .withColumn("chars_per_page", (F.col("chars") / F.greatest(F.col(pages), F.lit(1))).cast("decimal(12,1)"))
        .withColumn("ok", F.col("tier").isin("text_layer", "ocr"))
        .withColumn("error", fault)
        .drop("_rate", "_layer_chars")
    )


def tier_counts(extracted: DataFrame) -> DataFrame:
    """Documents, characters and whole characters per document of each tier."""
    return extracted.groupBy("tier").agg(F.count("*").alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).cast("long").alias("chars")).withColumn("avg_chars", F.expr("chars div n"))


def accounting(rows: DataFrame, outcome: Column) -> DataFrame:
    """Documents of each outcome with the total; outcomes exclude one another, so they add up to it."""
    counts = rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total))


def enough_rendered(pages: DataFrame, text: str = "text", least: int = 500) -> DataFrame:
    """Rendered pages whose text had loaded."""
    return pages.where(F.length(text) >= least)
