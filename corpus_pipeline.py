"""A training corpus from raw documents: five stages, each written and read again.

Quality rules drop boilerplate, near-duplicates keep one document of each group, secrets are
masked, the mix is brought to its target weights, and what stays is encoded.

Cases: an empty table gives an empty one at every stage. Null and empty texts fail the quality
rules. Rows that share an id or a text are judged one by one; near-duplicates keeps one of them.
Rows without an id go only where a copy with an id stays. Texts of any length are read whole. Columns beyond
those of documents go through all stages but the last unchanged, whatever their names; of those
whose name a stage uses for its own results, the input's values stay. The last stage gives
doc_id, lang, source, n_ids and ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import line_crf, piece_fst, secret_forest, simhash_ring, soft_mixing
from marlstone.storage import materialize, table

#: Jaccard similarity of five-word shingles from which documents are near copies.
SIMILARITY = 0.8
#: Targets as multiples of the tokens a domain has, without the documents of the barred ones.
#: Every other document has a rate above 1, so none of them is lost.
SHARES, BARRED = {"clean": 1.3, "junk": 1.2, "toxic": 1.25}, ("toxic",)


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with column names that no operator uses, and those names by the old ones."""
    names = {c: f"in{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose base rules hold and whose lines are mostly content."""
    weights = line_crf.train(docs, table(spark, sf_dir, "labels"))
    rows, at = _renamed(docs)
    return line_crf.annotate(rows, weights, text=at["text"], only_kept=True).select(*rows.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints or by five-word shingles."""
    return simhash_ring.keep_one(docs, similarity=SIMILARITY)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked and n_chars brought up to date."""
    return secret_forest.redact(docs, secret_forest.train(secret_forest.labelled_findings(spark)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; one copy more or less by its hash, so that totals are kept."""
    labels = table(spark, sf_dir, "labels")
    model = soft_mixing.train(docs, labels, soft_mixing.domain_of(labels), soft_mixing.DOMAINS)
    rows, at = _renamed(docs)
    mixed = soft_mixing.mix(rows, model, SHARES, text=at["text"], without=BARRED)
    copies = soft_mixing.copies(F.col("rate"), *[F.col(c) for c in rows.columns])
    return mixed.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)))).select(*rows.columns).toDF(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    return piece_fst.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"), without=("text",)).select("doc_id", "lang", "source", "n_ids", "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("encoding", encoding)]

#: Fingerprints, fitted models and piece ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
