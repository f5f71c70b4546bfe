"""Texts whose word shingles are alike: MinHash bands for candidates, then the exact Jaccard similarity.

A text has BANDS keys of ROWS least hashes each. Two texts of similarity s share a key with
probability 1 - (1 - s**ROWS)**BANDS, 0.99995 at 0.8. The members of a key's bucket are compared
all with each other; what is linked already is not compared. In buckets of more than FEW that is done
in two steps: first with the smallest and the largest member, which links most copies, then, where
buckets still have members that aren't linked, all pairs of these buckets' members. Those that share
members are one crowd, dealt into cells of parts of PART members; a task has the whole sets of a
cell, so that no pair is written, only what links the cell. Every link given has the similarity, by
all its shingles, or is one of a component of such links.

Cases: letters A to Z are folded; a null text, or one of fewer words than a shingle, has no keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import map_texts, mix, powers, raw, window_hashes, word_hashes, words
from marlstone.llm.spread import join_salted, join_spread
from marlstone.operators.components import connected_components, lowest
from marlstone.storage import materialize

SHINGLE, BANDS, ROWS = 5, 25, 5
#: Members of a bucket that are all compared with each other.
FEW = 32
#: Members of larger buckets that are a part, about, and their shingles at most; two parts meet in a cell.
PART, PART_SHINGLES = 256, 1 << 20
#: Columns of a cell's table of shingles at once.
WIDE = 4096
#: Links, 16 MB, whose components one task finds; of more they are found in rounds.
FEW_LINKS = 1 << 20
#: Ids of texts to compare that are broadcast, 16 MB; more are joined by shuffling.
FEW_IDS = 1_000_000


def _shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle, and the text it is of."""
    data, offsets = raw(column)
    folded = data.copy()
    folded[(folded >= 65) & (folded <= 90)] += 32
    start, end, first = words(folded, offsets)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    fits = np.arange(len(owner)) + width <= first[1:][owner]
    return window_hashes(word_hashes(folded, start, end), width)[fits], owner[fits]


BANDS_FIELD = T.StructField("bands", T.ArrayType(T.LongType()))


def bands_of(text: str = "text", shingle: int = SHINGLE):
    """What makes, for a slice, the keys of each text as column ``bands``."""

    def work():
        rng = np.random.default_rng(5)
        flip, factor = (rng.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
        factor |= np.uint64(1)

        def one(part: pa.RecordBatch) -> dict:
            h, owner = _shingles(part.column(part.schema.get_field_index(text)), shingle)
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(h) else np.zeros(0, np.int64)
            keys = np.zeros((len(heads), BANDS), np.uint64)
            if len(heads):
                for b in range(BANDS):
                    low = [np.minimum.reduceat((h ^ flip[i]) * factor[i], heads) for i in range(b * ROWS, (b + 1) * ROWS)]
                    keys[:, b] = mix((np.stack(low, axis=1) * powers(ROWS)).sum(axis=1, dtype=np.uint64) + np.uint64(b))
            has = np.zeros(part.num_rows, np.int64)
            has[owner[heads]] = BANDS
            return {"bands": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has)]).astype(np.int32)), pa.array(keys.ravel().view(np.int64)))}

        return one

    return work


def _with_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` with the distinct shingle hashes of column text in ``shingles`` instead."""

    def work():
        def one(part: pa.RecordBatch) -> dict:
            h, owner = _shingles(part.column(part.schema.get_field_index("text")), shingle)
            order = np.lexsort((h, owner))
            h, owner = h[order], owner[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            offsets = np.searchsorted(owner[new], np.arange(part.num_rows + 1)).astype(np.int32)
            return {"shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[new].view(np.int64)))}

        return one

    return map_texts(docs, "text", [T.StructField("shingles", T.ArrayType(T.LongType()))], work, without=("text",))


def _sets_of(ids: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """id, shingles and n, their number, of the texts named in ``ids`` (column i, distinct)."""
    needed = materialize(ids, "bands-needed")
    if needed.count() <= FEW_IDS:
        needed = F.broadcast(needed)  # no text that isn't compared is shuffled
    sets = _with_sets(texts.join(needed, F.col("id") == F.col("i"), "left_semi").dropDuplicates(["id"]), shingle)
    return materialize(sets.withColumn("n", F.size("shingles")), "bands-sets")


def _alike(found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """u, v of the candidates a, b, u, v that have the similarity."""
    one, two = (sets.select(F.col("id").alias(s), F.col("shingles").alias(f"s_{s}")) for s in ("a", "b"))
    near = F.least(F.size("s_a"), F.size("s_b")) >= F.greatest(F.size("s_a"), F.size("s_b")) * F.lit(similarity - 1e-9)
    shared = F.size(F.array_intersect("s_a", "s_b"))
    alike = shared / (F.size("s_a") + F.size("s_b") - shared)
    return join_salted(join_salted(found, one, "a"), two, "b").where(near).where(alike >= F.lit(similarity - 1e-9)).select("u", "v")


def _linked_in(similarity: float):
    """What gives, of a cell of texts in one part or two (group, whole, own, shingles), u, v: links that join all groups it finds alike."""

    def one(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        group, whole, own = (cell.column(c).to_numpy() for c in ("group", "whole", "own"))
        lists = cell.column("shingles").combine_chunks()
        n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        _, at, times = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        met = times > 1  # shingles of one text only add nothing
        column, owner = (np.cumsum(met) - 1)[at], np.repeat(np.arange(len(n)), n)
        column, owner = column[met[at]], owner[met[at]]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        a, b = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
        shared = np.zeros((len(a), len(b)))
        for first in range(0, int(met.sum()), WIDE):
            i, j = np.searchsorted(column, [first, first + WIDE])
            has = np.zeros((len(n), WIDE), np.float32)
            has[owner[i:j], column[i:j] - first] = 1
            shared += has[a] @ has[b].T
        alike = shared / (n[a][:, None] + n[b] - shared) >= similarity - 1e-9
        x, y = np.nonzero(alike & (whole[a][:, None] != whole[b]))
        u, v = lowest(group[a][x], group[b][y])
        return pa.table({"u": u[u != v], "v": v[u != v]})

    return one


def _rest(many: DataFrame, whole: DataFrame, sets: DataFrame, similarity: float) -> DataFrame | None:
    """u, v: links between members of large buckets (id, group, key) that the components ``whole`` leave apart; None if all are together."""
    many = many.join(whole, F.col("group") == F.col("node"), "left").select("id", "key", "group", F.coalesce("component", "group").alias("whole"))
    many = materialize(many, "bands-many")
    mixed = many.groupBy("key").agg(F.min("whole").alias("lo"), F.max("whole").alias("hi")).where("lo <> hi")
    rows = materialize(many.join(mixed, "key", "left_semi"), "bands-apart")
    if rows.isEmpty():
        return None
    # Buckets that share a member are one crowd, so that two texts meet once and not for each of their keys.
    crowds = connected_components(rows.select(F.col("id").alias("u"), F.col("key").alias("v")), "bands-crowds", FEW_LINKS)
    once = rows.groupBy("id").agg(F.first("group").alias("group"), F.first("whole").alias("whole"))
    once = once.join(crowds.select(F.col("node").alias("id"), F.col("component").alias("crowd")), "id")
    once = materialize(once.join(sets.select("id", "n"), "id"), "bands-once")
    parts = F.ceil(F.greatest(F.count("*") / PART, F.sum("n") / PART_SHINGLES)).cast("int")
    dealt = once.join(once.groupBy("crowd").agg(parts.alias("parts")), "crowd").withColumn("own", F.expr("cast(pmod(xxhash64(id), parts) as int)"))
    # Part p meets every part q in the cell of the unordered pair (p, q).
    cells = F.explode(F.transform(F.expr("sequence(0, parts - 1)"), lambda q: F.least(q, F.col("own")).cast("long") * F.col("parts") + F.greatest(q, F.col("own"))))
    dealt = dealt.join(sets.select("id", "shingles"), "id").select("crowd", cells.alias("cell"), "group", "whole", "own", "shingles")
    return materialize(dealt.groupBy("crowd", "cell").applyInArrow(_linked_in(similarity), "u long, v long"), "bands-rest")


def links(banded: DataFrame, texts: DataFrame, similarity: float, shingle: int = SHINGLE) -> DataFrame:
    """u, v: groups that hold two texts of the similarity.

    ``banded``: id, group and bands, a row for each text; ``texts``: id and text, repeated or not.
    """
    spots = banded.select("id", "group", F.explode("bands").alias("key"))
    # Most keys have one group; they go before anything else is gathered of them.
    met = spots.groupBy("key").agg(F.min("group").alias("g"), F.max("group").alias("most")).where(F.col("g") != F.col("most"))
    spots = spots.join(met.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi")
    spots = materialize(spots.select(F.struct("id", "group").alias("one"), "key"), "bands-shared")
    sizes = materialize(spots.groupBy("key").agg(F.min("one").alias("lo"), F.max("one").alias("hi"), F.count("*").alias("n"), F.count("*").alias("rows")), "bands-sizes")
    spots = materialize(join_spread(spots, sizes, ["key"], "rows"), "bands-met")
    few = spots.where(F.col("n") <= FEW).groupBy("key").agg(F.collect_list("one").alias("all"))
    few = few.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    many = spots.where(F.col("n") > FEW).select(F.col("one").alias("x"), F.explode(F.array("lo", "hi")).alias("y"))
    found = few.union(many).where("x.group <> y.group").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    found = found.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.group").alias("u"), F.col("y.group").alias("v")).distinct()
    found = materialize(found, "bands-candidates")
    large = spots.where(F.col("n") > FEW).select("one.id", "key", "one.group")
    needed = found.select(F.explode(F.array("a", "b")).alias("i")).union(large.select("id"))
    sets = _sets_of(needed.distinct(), texts, shingle)
    linked = materialize(_alike(found, sets, similarity), "bands-links")
    if large.isEmpty():
        return linked
    whole = connected_components(linked, "bands-linked", FEW_LINKS)
    rest = _rest(large, whole, sets, similarity)
    stars = whole.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return stars if rest is None else stars.union(rest)
