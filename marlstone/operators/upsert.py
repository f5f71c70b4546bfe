"""Upserts as pure functions: (target, stage) to the new target with each row's kind of change.

Parquet tables have no MERGE; ``sources.sinks.swap`` puts a result in its target's place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ranking import with_rank

# What the two loads refresh and what counts as a difference.
DOCUMENT_KEY, DOCUMENT_SET, DOCUMENT_DIFF = ["content_sha256"], ["source_ids", "body", "extract_tier", "chars", "page_count", "fetched_at"], ["body", "source_ids", "extract_tier", "chars", "page_count"]
SECTION_KEY, SECTION_SET = ["semester_code", "unique_number"], ["section_title", "instructor", "document_id", "cv_url"]

CHANGE = "change_kind"


def upsert(target: DataFrame, stage: DataFrame, key: list[str], update: list[str], diff: list[str] | None = None) -> DataFrame:
    """All rows after the upsert, with CHANGE: inserted, updated, unchanged or kept.

    Staged rows whose key exists change ``update`` only, and only if a column of ``diff`` is
    distinct (null-safe; None: always). Target columns missing from the stage stay as they are.
    """
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), stage.withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in key]
    both = t.join(s, on, "full_outer")
    differs = F.lit(True)
    if diff is not None:
        differs = F.lit(False)
        for c in diff:
            differs = differs | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    kind = F.when(F.col("s._s").isNull(), "kept").when(F.col("t._t").isNull(), "inserted").when(differs, "updated").otherwise("unchanged")
    both = both.withColumn(CHANGE, kind)
    out = []
    for c in target.columns:
        if c not in stage.columns:
            out.append(F.col(f"t.{c}").alias(c))
        elif c in update:
            out.append(F.when(F.col(CHANGE).isin("inserted", "updated"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col(CHANGE) == "inserted", F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return both.select(*out, CHANGE)


def upsert_documents(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Documents by content hash; new rows get the next ids in order of their hash."""
    return with_ids(upsert(target, stage, DOCUMENT_KEY, DOCUMENT_SET, DOCUMENT_DIFF), "content_sha256")


def upsert_sections(target: DataFrame, stage: DataFrame) -> DataFrame:
    return upsert(target, stage, SECTION_KEY, SECTION_SET, SECTION_SET)


def upsert_policies(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Scores by document and codebook version, without a difference test; an existing row keeps its ``model``."""
    key = ["document_id", "prompt_version"]
    return upsert(target, stage, key, [c for c in stage.columns if c not in [*key, "model"]])


def with_ids(rows: DataFrame, order: str, id_column: str = "id") -> DataFrame:
    """Fill null ids with numbers above the largest, by ``order``."""
    top = rows.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top"))
    new = with_rank(rows.where(F.col(id_column).isNull()).select(F.col(order).alias("_k")), [F.col("_k")], "_r")
    ids = new.crossJoin(F.broadcast(top)).select("_k", (F.col("top") + F.col("_r")).alias("_id"))  # one row of top
    return rows.join(ids, F.col(order) == F.col("_k"), "left").withColumn(id_column, F.coalesce(id_column, "_id")).drop("_k", "_id")


def evolve(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add a column if it isn't there."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
