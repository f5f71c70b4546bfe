"""The registered queries of this subpackage and their SQL.

Each takes (spark, sf_dir), applies its operator to the whole of its table and derives the
columns of its contract from the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import line_crf, minimax_shards, perspectives, piece_fst, secret_forest, simhash_ring, soft_mixing, sparse_suffix, token_store, uniform_topk
from marlstone.storage import new_path, table

SHARDS = 24
#: Multiples of the tokens that a domain has now; a trace of each is in every document, so none is at zero.
MIX_SHARES = {"clean": 1.05, "junk": 0.5, "toxic": 0.5}


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-store", released=True)
    token_store.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_store(spark, path)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.annotate(docs, weights, without=("text",))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = secret_forest.scan(docs, secret_forest.train(secret_forest.labelled_findings(spark)), without=("text",))
    return found.select("doc_id", F.explode("findings").alias("f")).select("doc_id", "f.*")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = soft_mixing.train(docs, labels, soft_mixing.domain_of(labels), soft_mixing.DOMAINS)
    return soft_mixing.mix(docs, model, MIX_SHARES, keep=["doc_id"])


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeated_passages(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_fst.verify(docs, public_tokenizers.path("piece_bpe_32k.model"), without=("text",))


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minimax_shards.shard(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents"))


def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_store, op2_quality_rules, op3_secret_scan, op4_topk, op5_soft_mixing, op6_repeated_passages, op7_sentencepiece, op8_minimax_shards, op9_simhash, op10_perspectives)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_topk": _TOPK, "op10_perspectives": _PERSPECTIVES}


_TOPK = """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM good q JOIN good c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_PERSPECTIVES = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce("text", '') AS content FROM conversations
), who AS (
    SELECT DISTINCT conv_id, name AS perspective FROM said WHERE name <> 'system'
), seen AS (
    SELECT said.*, perspective,
           CASE WHEN name = 'system' THEN 'system' WHEN name = perspective THEN 'assistant' ELSE 'user' END AS role
    FROM said JOIN who ON said.conv_id IS NOT DISTINCT FROM who.conv_id
), headed AS (
    SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || name ELSE '' END || chr(10) AS head FROM seen
), rendered AS (
    SELECT *, head || content || '<|im_end|>' || chr(10) AS rendered FROM headed
), placed AS (
    SELECT *, CAST(sum(length(rendered)) OVER w AS BIGINT) AS "end", row_number() OVER w - 1 AS seq
    FROM rendered
    WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, content ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, turn, seq, role, name, rendered,
       "end" - length(rendered) AS start,
       "end" - length(rendered) + length(head) AS content_start,
       "end" - length(rendered) + length(head) + length(content) AS content_end,
       "end",
       CAST(name = perspective AS INTEGER) AS loss_mask
FROM placed
"""
