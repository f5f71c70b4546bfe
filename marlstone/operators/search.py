"""Full-text search over a postings table.

Two configurations: ``simple`` lower-cases words of letters and digits; ``english`` also leaves
out stop words and stems, keeping positions. Queries follow the web-search form: words must all
occur, ``or`` between alternatives, ``-word`` excludes, ``"a b"`` is a phrase.

Words are runs of ASCII letters and digits; compound tokens of URLs and hyphenated words are
not made.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.stemmer import STOP_WORDS, stem
from marlstone.sources.records import exists
from marlstone.storage import drop_path, new_path

CONFIGS = ("simple", "english")
_TOKEN = re.compile("[a-z0-9]+")


@F.pandas_udf(T.StringType())
def _stem(s: pd.Series) -> pd.Series:
    return s.map(lambda w: None if w is None else stem(w))


def postings(docs: DataFrame, doc_id: str = "doc_id", body: str = "text", config: str = "simple") -> DataFrame:
    """token, doc_id, positions (ascending, from 0); documents without text have none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(body), F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(words).alias("pos", "token"))
    if config == "english":
        # Stems are made once for each word of the vocabulary, not for each occurrence.
        stems = rows.select("token").distinct().where(~F.col("token").isin(*STOP_WORDS)).withColumn("stem", _stem("token"))
        rows = rows.join(stems, "token").select("doc_id", "pos", F.col("stem").alias("token"))
    return rows.groupBy("token", "doc_id").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


#: Bytes of a row group of stored postings: what a lookup of one token reads at least.
ROW_GROUP = 4 << 20
_STORED: dict[tuple, str] = {}


def write_postings(posted: DataFrame, path: str) -> None:
    """Sorted by token, so that a lookup reads few row groups and, of those, few pages."""
    ordered = posted.repartitionByRange("token", "doc_id").sortWithinPartitions("token", "doc_id")
    ordered.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)


def stored(docs: DataFrame, doc_id: str = "doc_id", body: str = "text", config: str = "simple") -> DataFrame:
    """The postings of documents read from files, built once a session and read from the shared folder by every query after.

    The same files, columns and configuration share one index; other files get their own.
    """
    spark = docs.sparkSession
    key = (spark.sparkContext.applicationId, tuple(sorted(docs.inputFiles())), doc_id, body, config)
    if key not in _STORED or not exists(spark, _STORED[key]):
        path = new_path(spark, "postings")
        write_postings(postings(docs, doc_id, body, config), path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def forget(spark: SparkSession) -> None:
    """Remove the stored postings of this session."""
    for key in [k for k in _STORED if k[0] == spark.sparkContext.applicationId]:
        drop_path(spark, _STORED.pop(key))


@dataclass
class Term:
    """Words in a row (one: a plain word); ``offsets``: their distances, stop words counted."""

    words: list[str]
    offsets: list[int]
    excluded: bool = False


@dataclass
class Query:
    """Alternatives of terms that must all hold."""

    either: list[list[Term]] = field(default_factory=list)


def parse(text: str, config: str = "simple") -> Query:
    """A web-search query. Terms of stop words alone don't count."""
    query, current = Query(), []
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', text):
        if word.lower() == "or" and not minus:
            if current:
                query.either.append(current)
            current = []
            continue
        tokens = _TOKEN.findall((phrase or word).lower())
        kept = [(i, t) for i, t in enumerate(tokens) if config == "simple" or t not in STOP_WORDS]
        if kept:
            words = [stem(t) if config == "english" else t for _, t in kept]
            current.append(Term(words, [i - kept[0][0] for i, _ in kept], bool(minus)))
    if current:
        query.either.append(current)
    return query


def _shifted(offset: int) -> Column:
    return F.transform("positions", lambda p: p - F.lit(offset))


def _having(posted: DataFrame, term: Term) -> DataFrame:
    """doc_id of documents that hold a term; a phrase joins its words' postings, shifted."""
    parts = [posted.where(F.col("token") == w).select("doc_id", _shifted(o).alias(f"p{i}")) for i, (w, o) in enumerate(zip(term.words, term.offsets))]
    if len(parts) == 1:
        return parts[0].select("doc_id")
    both = reduce(lambda a, b: a.join(b, "doc_id"), parts)
    return both.where(F.size(reduce(F.array_intersect, [F.col(f"p{i}") for i in range(len(parts))])) > 0).select("doc_id")


def search(posted: DataFrame, text: str, config: str = "simple", all_docs: DataFrame | None = None) -> DataFrame:
    """doc_id of the matching documents. ``all_docs`` (doc_id) serves alternatives of excluded terms alone."""
    parts = []
    for terms in parse(text, config).either:
        wanted, barred = [t for t in terms if not t.excluded], [t for t in terms if t.excluded]
        if wanted:
            found = reduce(lambda a, b: a.join(b, "doc_id", "left_semi"), [_having(posted, t) for t in wanted])
        elif all_docs is not None:
            found = all_docs.select("doc_id")
        else:
            raise ValueError("a query of excluded terms alone needs all_docs")
        parts.append(reduce(lambda a, b: a.join(_having(posted, b), "doc_id", "left_anti"), barred, found))
    if not parts:
        return posted.select("doc_id").limit(0)
    return reduce(DataFrame.unionByName, parts).distinct()


def rollup(found: DataFrame, sections: DataFrame, by: str = "department") -> DataFrame:
    """Sections of the matching documents by department, most first."""
    rows = sections.join(found.withColumnRenamed("doc_id", "document_id"), "document_id", "left_semi")
    return rows.groupBy(by).agg(F.count("*").alias("sections")).orderBy(F.desc("sections"), by)


def term_frequency(posted: DataFrame, words: list[str], sections: DataFrame) -> DataFrame:
    """token, documents and sections that mention each word."""
    from marlstone.operators.report import sections_per_document

    hits = posted.where(F.col("token").isin(*words)).select("token", "doc_id")
    rows = hits.join(sections_per_document(sections).withColumnRenamed("document_id", "doc_id"), "doc_id", "left")
    return rows.groupBy("token").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n_sections"), F.lit(0)).alias("sections"))
