"""The corpus's tables, derived from the driver's by whole-number formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.schemas import SCALES
from marlstone.storage import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, body (null for quarantined documents), source, lang."""
    rows = table(spark, sf_dir, "documents")
    return rows.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 97 != 0, F.col("text")).alias("body"), "source", "lang")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """section_id, department, course, instructor, document_id of every event."""
    n = table(spark, sf_dir, "documents").count()
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    m = (F.col("event_id") * (F.col("event_id") % 7 + 1)) % F.lit(max(n, 1))
    return e.select(
        F.col("event_id").alias("section_id"),
        F.col("event_type").alias("department"),
        F.concat(F.lit("C"), (F.col("event_id") % 5).cast("string")).alias("course"),
        F.when(F.col("event_id") % 53 != 0, F.col("user_id")).alias("instructor"),
        F.when(m % 13 != 5, m).alias("document_id"),
    )


def scores(spark: SparkSession, sf_dir: str, coder: int = 1) -> DataFrame:
    """document_id, completeness, scale, score, status, required; the second coder deviates now and then."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    rows = d.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("scale")) for k, s in enumerate(SCALES)])).alias("s"))
    i, k = F.col("doc_id"), F.col("s.k")
    score = (i * 7 + F.floor(i / 6) + 3 * k) % 6
    if coder == 2:
        score = F.when(i % 10 == 0, (score + 1) % 6).when(i % 37 == 0, (score + 2) % 6).otherwise(score)
    status = F.when(i % 11 == 0, "undecided").when(i % 11 == 1, "contradictory").otherwise("clear")
    return rows.select(i.alias("document_id"), F.when(i % 29 == 0, "stub").otherwise("full").alias("completeness"), F.col("s.scale").alias("scale"), score.cast("int").alias("score"), status.alias("status"), ((i + k) % 5 == 0).alias("required"))


# The same in SQL.
SQL = """
n AS (SELECT count(*) AS n FROM documents),
docs AS (SELECT doc_id AS id, CASE WHEN doc_id % 97 <> 0 THEN "text" END AS body, source, lang FROM documents),
sections AS (
    SELECT event_id AS section_id, event_type AS department, 'C' || CAST(event_id % 5 AS VARCHAR) AS course,
           CASE WHEN event_id % 53 <> 0 THEN user_id END AS instructor,
           CASE WHEN m % 13 <> 5 THEN m END AS document_id
    FROM (SELECT *, (event_id * (event_id % 7 + 1)) % (SELECT n FROM n) AS m FROM events)
),
scales AS (SELECT * FROM (VALUES (0, 'phone'), (1, 'laptop'), (2, 'ai')) t(k, scale)),
scores AS (
    SELECT doc_id AS document_id, CASE WHEN doc_id % 29 = 0 THEN 'stub' ELSE 'full' END AS completeness, scale,
           CAST((doc_id * 7 + doc_id // 6 + 3 * k) % 6 AS INTEGER) AS score,
           CASE WHEN doc_id % 11 = 0 THEN 'undecided' WHEN doc_id % 11 = 1 THEN 'contradictory' ELSE 'clear' END AS status,
           (doc_id + k) % 5 = 0 AS required
    FROM documents, scales
),
scores2 AS (
    SELECT * REPLACE (CAST(CASE WHEN document_id % 10 = 0 THEN (score + 1) % 6 WHEN document_id % 37 = 0 THEN (score + 2) % 6 ELSE score END AS INTEGER) AS score) FROM scores
),
held AS (SELECT document_id, count(*) AS n_sections FROM sections WHERE document_id IS NOT NULL GROUP BY 1),
scored AS (SELECT s.*, coalesce(n_sections, 0) AS n_sections, completeness = 'full' AS is_full, completeness = 'full' AND status = 'clear' AS is_clear FROM scores s LEFT JOIN held USING (document_id))
"""


def with_views(sql: str) -> str:
    return f"WITH {SQL.strip()},\n{sql.strip()}"
