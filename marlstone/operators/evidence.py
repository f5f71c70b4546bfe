"""Quotes against the documents they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import normalize, pct, resembles, split_quotes
from marlstone.operators.ranking import with_rank
from marlstone.storage import materialize

#: Bytes of quotes that are broadcast to the bodies; more are joined by shuffling.
FEW_BYTES = 32 << 20
#: Quotes of one or two words that a body is checked against at once.
SHORT_BLOCK = 500

EXACT, FUZZY, MISSING = "substring", "fuzzy", "not found"


def match(quotes: DataFrame, bodies: DataFrame, key: str = "document_id", quote: str = "quote", body: str = "body") -> DataFrame:
    """``quotes`` with ``how``: substring, fuzzy or not found, after normalizing both sides.

    Bodies are normalized once each, not once for each quote. The costly fuzzy tier sees only
    what is not a substring.
    """
    texts = bodies.join(quotes.select(F.col(key).alias("_q")).distinct(), F.col(key) == F.col("_q"), "left_semi").select(F.col(key).alias("_k"), normalize(F.col(body)).alias("_b"))
    rows = quotes.withColumn("_n", normalize(F.col(quote))).join(texts, F.col(key) == F.col("_k"), "left")
    hit = (F.col("_n") != "") & F.coalesce(F.contains("_b", "_n"), F.lit(False))
    rows = rows.withColumn("_hit", hit)
    left = ~F.col("_hit") & (F.col("_n") != "")  # what the fuzzy tier is asked for; of the rest it gets nulls
    rows = rows.withColumn("_like", resembles(F.when(left, F.col("_n")), F.when(left, F.col("_b"))))
    return rows.withColumn("how", F.when(F.col("_hit"), EXACT).when(F.col("_like"), FUZZY).otherwise(MISSING)).drop("_k", "_b", "_n", "_hit", "_like")


def policy_quotes(policies: DataFrame, scales: tuple[str, ...]) -> DataFrame:
    """document_id, scale, score, quote of non-zero scores with evidence."""
    parts = F.explode(F.array(*[F.struct(F.lit(s).alias("scale"), F.col(f"{s}_score").alias("score"), F.col(f"{s}_evidence").alias("evidence")) for s in scales]))
    rows = policies.select("document_id", parts.alias("p")).where((F.col("p.score") != 0) & F.col("p.evidence").isNotNull())
    return rows.select("document_id", "p.scale", "p.score", F.explode(split_quotes(F.col("p.evidence"))).alias("quote"))


def audit(policies: DataFrame, documents: DataFrame, scales: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """One row of counts and shares, and the quotes that were not found. Shares are null without quotes."""
    bodies = documents.where(F.col("body").isNotNull()).select(F.col("id").alias("document_id"), "body")
    rows = policies.join(bodies.select("document_id"), "document_id", "left_semi")
    matched = match(policy_quotes(rows, scales), bodies)
    counts = matched.agg(F.count("*").alias("checked"), F.count_if(F.col("how") == EXACT).alias("exact"), F.count_if(F.col("how") == FUZZY).alias("normalized"), F.count_if(F.col("how") == MISSING).alias("not_found"))
    counts = rows.agg(F.count("*").alias("rows_audited")).crossJoin(counts)
    return counts.select("*", pct(F.col("exact"), F.col("checked")).alias("exact_pct"), pct(F.col("normalized"), F.col("checked")).alias("normalized_pct")), matched.where(F.col("how") == MISSING)


def containing(quotes: DataFrame, bodies: DataFrame, key: str, quote: str, doc_id: str, body: str) -> DataFrame:
    """``key`` and ``doc_id`` of every normalized, non-empty quote that a normalized body contains.

    A quote may begin and end inside a word of the body, so all its words but the first and the
    last are whole there. Candidates share the first of those: three in a row, or as many as the
    quote has. Few quotes are broadcast and meet the bodies' word groups where these are made;
    many are joined by shuffling. Quotes of one or two words have no whole word; they are dealt
    into blocks, and a body is checked against a block's quotes one by one.
    """
    bodies = materialize(bodies.select(F.col(doc_id).alias("d"), F.col(body).alias("b")), "quote-bodies")
    words, w = F.split("q", " "), F.split("b", " ")
    n = F.greatest(F.least(F.size(words) - 2, F.lit(3)), F.lit(0))
    keyed = quotes.select(F.col(key).alias("i"), F.col(quote).alias("q")).withColumn("n", n)
    keyed = materialize(keyed.withColumn("k", F.array_join(F.slice(words, F.lit(2), F.col("n")), " ")), "quote-keys")
    sizes = {r.n: r for r in keyed.groupBy("n").agg(F.sum(F.octet_length("q") + F.octet_length("k") + 32).alias("bytes"), F.count("*").alias("rows")).collect()}  # n is 0 to 3
    hits = [_short(keyed.where("n = 0").select("i", "q"), bodies, sizes[0].rows)] if 0 in sizes else []
    for n in sorted(sizes.keys() - {0}):
        mine = keyed.where(F.col("n") == n).select("i", "q", "k")
        grams = F.explode(F.array_distinct(_grams(w, n)))
        if sizes[n].bytes <= FEW_BYTES:
            near = bodies.select("d", "b", grams.alias("k")).join(F.broadcast(mine), "k")
        else:
            near = bodies.select("d", grams.alias("k")).join(mine, "k").select("d", "i", "q").distinct().join(bodies, "d")
        hits.append(near.where(F.contains("b", "q")).select("i", "d"))
    found = hits[0] if hits else keyed.select("i", F.lit(None).cast(bodies.schema["d"].dataType).alias("d")).limit(0)
    for more in hits[1:]:
        found = found.union(more)
    return found.distinct().select(F.col("i").alias(key), F.col("d").alias(doc_id))


def _grams(words: Column, n: int) -> Column:
    shifted = F.arrays_zip(*[F.slice(words, 1 + j, 1 << 30).alias(f"w{j}") for j in range(n)])
    return F.transform(shifted, lambda r: F.concat_ws(" ", *[r[f"w{j}"] for j in range(n)]))


def _short(quotes: DataFrame, bodies: DataFrame, rows: int) -> DataFrame:
    blocks = -(-rows // SHORT_BLOCK)
    lists = with_rank(quotes, [F.col("q"), F.col("i")], "_rank").groupBy(F.expr(f"cast((_rank - 1) div {SHORT_BLOCK} as int)").alias("block")).agg(F.collect_list(F.struct("i", "q")).alias("quotes"))
    lists = F.broadcast(lists) if rows <= 100 * SHORT_BLOCK else lists
    dealt = bodies.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(lists, "block")
    return dealt.select("d", F.explode(F.filter("quotes", lambda x: F.contains(F.col("b"), x["q"]))).alias("x")).select("x.i", "d")
