"""Near-duplicate documents: bottom-k sketches, a prefix-filtered similarity join, components.

A sketch holds the SKETCH smallest distinct hashes of a document's five-word shingles. Of two
sketches the SKETCH smallest hashes of both together form a window; the share of it in both
estimates their Jaccard similarity. The window is as large as either sketch at least, so with a
threshold of 0.70 two sketches, the larger of n hashes, share o = ceil(0.7 * n) hashes or more.
Put in any one order, here rare ones first, the first len - o + s hashes of both then have s in
common: of those o the s-th has o - s behind it. So every qualifying pair meets s times in an
equi-join of such heads, and no pair is lost, whatever the frequencies are: they only
decide how many others meet.

Documents with equal sketches and lengths are one class and join once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.text import letters_only, pct
from marlstone.operators.components import connected_components
from marlstone.storage import materialize

# The method's settings.
SHINGLE, SKETCH, THRESHOLD, MIN_WORDS, TOLERANCE = 5, 256, 0.70, 120, 0.40
#: Hashes that the heads of a candidate pair have in common, or all that the threshold asks for, if those are fewer.
SHARED = 8
#: Frequent hashes that are gathered to order the hashes of sketches, 9 bytes each.
MOST_FREQUENT = 500_000
#: Ids that are broadcast; more are joined by shuffling.
FEW_IDS = 1_000_000


def _blake2b(b: bytes) -> bytes:
    return hashlib.blake2b(b, digest_size=8).digest()


def _md5(b: bytes) -> bytes:
    return hashlib.md5(b, usedforsecurity=False).digest()[:8]


#: blake2b64 gives the published results, md5_64 is the one SQL engines have too.
HASHES: dict[str, Callable[[bytes], bytes]] = {"blake2b64": _blake2b, "md5_64": _md5}


def sketch_of(text: str | None, hash_name: str = "blake2b64") -> tuple[list[int] | None, int]:
    """Ascending hashes as signed longs in the order of the unsigned ones, and the number of words."""
    tokens = letters_only(text or "")
    if len(tokens) < MIN_WORDS:
        return None, len(tokens)
    digest = HASHES[hash_name]
    shingles = {" ".join(tokens[i : i + SHINGLE]) for i in range(len(tokens) - SHINGLE + 1)}
    raw = np.frombuffer(b"".join(digest(s.encode()) for s in shingles), ">u8")
    low = np.unique(raw)[:SKETCH]
    return (low ^ np.uint64(1 << 63)).astype(np.uint64).view(np.int64).tolist(), len(tokens)


def sketches(docs: DataFrame, doc_id: str = "doc_id", body: str = "text", hash_name: str = "blake2b64") -> DataFrame:
    """doc_id, n_words, sketch of documents long enough to judge."""
    rows = docs.where(F.col(body).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(body).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [sketch_of(t, hash_name) for t in part.column(1).to_pylist()]
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array([n for _, n in found], pa.int32()), pa.array([s for s, _ in found], pa.list_(pa.int64()))], names=["doc_id", "n_words", "sketch"])
                yield out.filter(pa.array([s is not None for s, _ in found]))

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words int, sketch array<long>")


def classes(sketched: DataFrame) -> DataFrame:
    """doc_id, rep: the smallest id with the same sketch and length."""
    keyed = sketched.select("doc_id", F.sha2(F.concat_ws(",", F.col("n_words").cast("string"), F.array_join(F.transform("sketch", lambda h: h.cast("string")), ",")), 256).alias("k"))
    first = keyed.groupBy("k").agg(F.min("doc_id").alias("rep"))
    return keyed.join(first, "k").select("doc_id", "rep")


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that a batch of sketches has twice or more, and how often."""
    for batch in batches:
        flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        h, n = np.unique(flat, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h[n > 1]), pa.array(n[n > 1])], names=["h", "n"])


def frequent(sketched: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes that many sketches have, MOST_FREQUENT at most, and the binary logarithm of how many.

    This only orders the hashes of a sketch; any order gives the same pairs, so hashes that are
    counted low, or not, cost time alone.
    """
    counts = sketched.select("sketch").mapInArrow(_often, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n >= 8").select("h", F.floor(F.log2("n")).cast("byte").alias("level"))
    counts = materialize(counts, "sketch-frequent")
    least, rows = 0, 0
    for r in sorted(counts.groupBy("level").agg(F.count("*").alias("c")).collect(), reverse=True):  # a row for each power of two
        rows += r.c
        if rows > MOST_FREQUENT:
            least = r.level + 1
            break
    found = counts.where(F.col("level") >= least).toArrow()
    h, level = (found.column(c).to_numpy() for c in ("h", "level"))
    order = np.argsort(h)
    return h[order], level[order]


def _heads(threshold: float, often: np.ndarray, levels: np.ndarray):
    """The rarest hashes of each sketch: as many as leave less than the threshold's share behind, and SHARED - 1 more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sketch = part.column(2)
                flat, size = sketch.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(sketch).to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(part.num_rows), size)
                level = np.zeros(len(flat), np.int8)
                if len(often):
                    spot = np.minimum(np.searchsorted(often, flat), len(often) - 1)
                    level = np.where(often[spot] == flat, levels[spot], 0).astype(np.int8)
                order = np.lexsort((flat, level, owner))
                share = np.maximum(np.ceil(size * threshold - 1e-9).astype(np.int64), 1)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                taken = place < (size - share + SHARED)[owner]
                who = pa.array(owner[taken])
                yield pa.RecordBatch.from_arrays([part.column(0).take(who), part.column(1).take(who), pa.array(np.minimum(share, SHARED)[owner[taken]].astype(np.int8)), pa.array(flat[order][taken])], names=["doc_id", "n_words", "need", "h"])

    return run


def candidate_pairs(sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b (a < b) within the length band whose rarest hashes have as many in common as those of every qualifying pair."""
    kind = sketched.schema["doc_id"].dataType.simpleString()
    heads = sketched.select("doc_id", "n_words", "sketch").mapInArrow(_heads(threshold, *frequent(sketched)), f"doc_id {kind}, n_words int, need byte, h long")
    x, y = (heads.select(F.col("doc_id").alias(s), F.col("n_words").alias(f"n_{s}"), F.col("need").alias(f"need_{s}"), "h") for s in ("a", "b"))
    band = F.greatest("n_a", "n_b") <= F.least("n_a", "n_b") * F.lit(1.4)
    met = x.join(y, (x["h"] == y["h"]) & (F.col("a") < F.col("b")) & band)
    return met.groupBy("a", "b").agg(F.count("*").alias("c"), F.first(F.greatest("need_a", "need_b")).alias("need")).where("c >= need").select("a", "b")


def similar_pairs(sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b (a < b), similarity of pairs at or above the threshold within the length band."""
    candidates = materialize(candidate_pairs(sketched, threshold), "sketch-candidates")
    needed = materialize(candidates.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "sketch-needed")
    if needed.count() <= FEW_IDS:
        needed = F.broadcast(needed)  # no sketch that isn't compared is shuffled
    sketched = sketched.join(needed, "doc_id", "left_semi")
    one, two = (sketched.select(F.col("doc_id").alias(s), F.col("sketch").alias(f"s_{s}")) for s in ("a", "b"))
    pairs = candidates.join(one, "a").join(two, "b")
    window = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect(window, F.col("s_a")), F.col("s_b")))
    return pairs.select("a", "b", (shared / F.size(window)).alias("similarity")).where(F.col("similarity") >= threshold)


def plausible_pairs(sketched: DataFrame) -> DataFrame:
    """pairs_compared: how many pairs of documents are within the length band, counted without forming them.

    Only the number of documents of each length is gathered; the documents up to the band's end
    come from running totals over lengths and band ends in one order.
    """
    sizes = sketched.groupBy(F.col("n_words").cast("double").alias("at")).agg(F.count("*").alias("c"))
    ends = sizes.select((F.col("at") * F.lit(1.0 + TOLERANCE)).alias("at"), F.lit(0).cast("long").alias("c"), F.col("c").alias("mine"), F.col("at").alias("of"))
    both = sizes.select("at", "c", F.lit(None).cast("long").alias("mine"), F.lit(None).cast("double").alias("of")).unionByName(ends)
    upto = F.sum("c").over(Window.orderBy("at", F.col("mine").isNotNull()).rowsBetween(Window.unboundedPreceding, 0))  # one row for each length and band end
    placed = both.withColumn("upto", upto)
    own = placed.where("mine is null").select(F.col("at").alias("l"), F.col("upto").alias("before"))
    counts = placed.where("mine is not null").join(own, F.col("of") == F.col("l"))
    n = F.col("mine")
    return counts.agg(F.coalesce(F.sum((n * (n - 1) / 2).cast("long") + n * (F.col("upto") - F.col("before"))), F.lit(0)).alias("pairs_compared"))


def linked(docs: DataFrame, doc_id: str = "doc_id", body: str = "text", hash_name: str = "blake2b64") -> tuple[DataFrame, DataFrame]:
    """(links between class representatives, membership doc_id to rep)."""
    return linked_sketches(materialize(sketches(docs, doc_id, body, hash_name), "sketches"))


def linked_sketches(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Like ``linked``, from a table of sketches."""
    members = materialize(classes(sketched), "sketch-classes")
    reps = members.where(F.col("doc_id") == F.col("rep")).select("doc_id")
    if reps.count() <= FEW_IDS:
        reps = F.broadcast(reps)  # sketches are not shuffled
    own = sketched.join(reps, "doc_id", "left_semi")
    return materialize(similar_pairs(own), "sketch-pairs"), members


def clusters(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """doc_id, root (the cluster's smallest id), size of documents in clusters of two or more."""
    of = connected_components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")), "neardup")
    rows = members.join(of.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("root"))
    sizes = rows.groupBy("root").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "root").select("doc_id", "root", "size")


def groups(clustered: DataFrame) -> DataFrame:
    """doc_id and its near_duplicate_group."""
    return clustered.select("doc_id", F.concat(F.lit("nd"), F.col("root").cast("string")).alias("near_duplicate_group"))


def write_back(documents: DataFrame, clustered: DataFrame, doc_id: str = "id", clear_old: bool = False) -> DataFrame:
    """Documents with near_duplicate_group set for clusters; old labels of others stay unless cleared."""
    from marlstone.operators.upsert import evolve

    rows = evolve(documents, "near_duplicate_group", "string")
    new = groups(clustered).select(F.col("doc_id").alias("_d"), F.col("near_duplicate_group").alias("_g"))
    rows = rows.join(new, F.col(doc_id) == F.col("_d"), "left")
    return rows.withColumn("near_duplicate_group", F.col("_g") if clear_old else F.coalesce("_g", "near_duplicate_group")).drop("_d", "_g")


def redundant(clustered: DataFrame) -> DataFrame:
    """All but the smallest id of each cluster."""
    return clustered.where(F.col("doc_id") != F.col("root")).select("doc_id")


def statistics(docs: DataFrame, clustered: DataFrame, body: str = "text", sketched: DataFrame | None = None) -> DataFrame:
    """examined, clusters, inside, redundant, redundant_pct of all documents with text, and what is left; with ``sketched`` also pairs_compared."""
    all_ = docs.where(F.col(body).isNotNull()).agg(F.count("*").alias("examined"))
    found = clustered.agg(F.countDistinct("root").alias("clusters"), F.count("*").alias("inside"))
    rows = all_.crossJoin(found).withColumn("redundant", F.col("inside") - F.col("clusters"))
    rows = rows.select("*", pct(F.col("redundant"), F.col("examined")).alias("redundant_pct"), (F.col("examined") - F.col("redundant")).alias("after_collapsing"))
    return rows if sketched is None else rows.crossJoin(plausible_pairs(sketched))  # one row each


def largest(clustered: DataFrame, n: int = 10) -> DataFrame:
    """The n largest clusters."""
    return clustered.groupBy("root").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "root").limit(n)


def modal_value(clustered: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """root, value, n: each cluster's most frequent value (doc_id, value); ties go to the smaller value."""
    counts = clustered.select("doc_id", "root").join(values, "doc_id").groupBy("root", value).agg(F.count("*").alias("n"))
    best = counts.groupBy("root").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value))).alias("b"))
    return best.select("root", F.col(f"b.{value}").alias(value), (-F.col("b.m")).alias("n"))


def dedup_sensitivity(scores: DataFrame, clustered: DataFrame) -> DataFrame:
    """Per scale: strict share of addressed clear rows as it is and without redundant copies, and the difference."""
    from marlstone.operators.report import strict_share

    drop = redundant(clustered).select(F.col("doc_id").alias("document_id"))
    a = strict_share(scores).select("scale", F.col("strict").alias("strict_all"), F.col("addressed").alias("addressed_all"), F.col("strict_pct").alias("as_is_pct"))
    b = strict_share(scores.join(drop, "document_id", "left_anti")).select("scale", F.col("strict").alias("strict_dedup"), F.col("addressed").alias("addressed_dedup"), F.col("strict_pct").alias("dedup_pct"))
    return a.join(b, "scale").withColumn("difference", F.col("dedup_pct") - F.col("as_is_pct"))
