"""Which documents go to the coders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def selected(documents: DataFrame, sample: DataFrame | None, split: str = "dev") -> DataFrame:
    """document_id and body in order of id: all with text, or those of one split of the sample."""
    rows = documents.where(F.col("body").isNotNull()).select(F.col("id").alias("document_id"), "body")
    if split != "all":
        rows = rows.join(sample.where(F.col("split") == split).select("document_id").distinct(), "document_id", "left_semi")
    return rows.orderBy("document_id")
