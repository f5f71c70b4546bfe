"""Exact top-k inner products by a three-phase uniform threshold.

A vector's coordinates are dealt to ``LISTS`` score lists; a candidate's score for a query is
the sum of its entries in the lists. Candidates and queries are packed into blocks of the smallest
numbers that hold them. The stated queries meet all candidates in cells: a cell holds up to
QUERY_GROUP blocks of queries, past which its blocks of candidates stream, so a block of candidates is
shuffled once for each group of queries, and a query once for each group of candidates.

1. Each block of candidates hands on the heads of its sorted coordinates: the candidates with
   the k largest or k smallest values of any coordinate. Their scores are local lower bounds;
   the k-th best over all cells is a query's cutoff: at least k candidates reach it.
2. The cutoff goes to every block. A candidate whose entries all stay under cutoff / LISTS can't
   reach it. A list is sorted by the length of its candidates' part, which bounds their entries:
   only the head of each list that may hold entries of cutoff / LISTS is computed. A candidate
   whose entries so far, with the least bound for each missing one, stay under the cutoff goes.
3. The missing entries of the rest are looked up; candidates under the cutoff go, and the k
   best by (score descending, id ascending) are the answer.

Scores are integers: component x counts as floor(256 * x), x as double. They are exact for
components of any size: products are taken as doubles while all sums stay below 2**53, as
64-bit integers below 2**62, and as whole numbers of any length above. A score beyond 64 bits
is given, and compared, as the nearest 64-bit integer. Shorter vectors count as if filled up
with zeros.

Cases: vectors that are null or hold a null or non-finite component (also after times 256) take
no part, nor do null ids. Rows that share an id are candidates each, and queries of one id are
answered together; a row of the query's own id is not a candidate of it. Among equal vectors of
a block 2 * k rows suffice, so large groups of copies stay small. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marlstone.storage import materialize

LISTS = 4
CANDIDATES, QUERIES = 4096, 512  # vectors in a block
STRIP = 128  # queries of a block whose lists are held at once
QUERY_GROUP, CANDIDATE_GROUP = 64, 64  # blocks of a cell at most
CELLS = 4  # for each core, as far as there are blocks
_KINDS = ("i1", "i2", "i4", "f8")  # what a block's components are stored as
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_BLOCK = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("dims", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("ids", T.BinaryType()), T.StructField("matrix", T.BinaryType()), T.StructField("heads", T.BinaryType())])


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and components as doubles of every row that takes part."""
    x = F.col(vector).cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * 256 < F.lit(float("inf"))))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("v"))


def thinned(ids: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the k best of any query: of equal vectors k of each id, and of those the 2 * k of the smallest ids."""
    order = np.lexsort((ids, *c.T[::-1])) if c.shape[1] else np.argsort(ids, kind="stable")
    same = np.concatenate([[False], (c[order[1:]] == c[order[:-1]]).all(axis=1)])
    again = same & np.concatenate([[False], ids[order[1:]] == ids[order[:-1]]])

    def place(follows: np.ndarray) -> np.ndarray:
        at = np.arange(len(follows))
        return at - np.maximum.accumulate(np.where(follows, 0, at))

    few = place(again) < k
    order, starts = order[few], np.cumsum(~same)[few]
    return np.sort(order[place(np.concatenate([[False], starts[1:] == starts[:-1]])) < 2 * k])


def heads_of(c: np.ndarray, k: int) -> np.ndarray:
    """Rows with one of the k largest or smallest values of a coordinate."""
    take = min(k, len(c))
    if not c.shape[1]:
        return np.arange(take)
    order = np.argsort(c, axis=0, kind="stable")
    return np.unique(np.concatenate([order[:take].ravel(), order[len(c) - take :].ravel()]))


def _pack(size: int, k: int | None):
    """Rows to blocks; with ``k``, blocks of candidates with their heads."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[list[float]] = []

        def close() -> pa.RecordBatch:
            matrix = np.zeros((len(rows), max(map(len, rows))))
            for i, r in enumerate(rows):
                matrix[i, : len(r)] = r
            matrix, names = np.floor(matrix * 256), np.array(ids, np.int64)
            heads = np.zeros(0, np.int32)
            if k is not None:
                keep = thinned(names, matrix, k)
                matrix, names = matrix[keep], names[keep]
                heads = heads_of(matrix, k).astype(np.int32)
            ids.clear()
            rows.clear()
            most = np.abs(matrix).max(initial=0)
            kind = next((t for t in _KINDS[:-1] if most <= np.iinfo(t).max), _KINDS[-1])
            block = [len(names), matrix.shape[1], kind, names.tobytes(), matrix.astype(kind).tobytes(), heads.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([b], t) for b, t in zip(block, (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()))], names=_BLOCK.names)

        for batch in batches:
            for i, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                rows.append(r)
                if len(rows) == size:
                    yield close()
        if rows:
            yield close()

    return pack


def _only_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of candidates to blocks of their heads alone."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids, c = _unpack(row)
            at = np.frombuffer(row["heads"], np.int32)
            row |= {"n": len(at), "ids": ids[at].tobytes(), "matrix": c[at].astype(row["kind"]).tobytes(), "heads": b""}
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in batch.schema], names=batch.schema.names)


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks with gapless numbers, by way of their order of ids; only the ids' heads are sorted."""
    blocks = materialize(blocks.withColumn("key", F.sha2(F.concat("ids", "matrix"), 256)), name)
    keys = blocks.select("key").distinct().withColumn("part", F.substring("key", 1, 3))
    at = keys.groupBy("part").agg(F.count("*").alias("c")).withColumn("base", F.sum("c").over(Window.orderBy("part")) - F.col("c"))
    numbers = keys.join(F.broadcast(at), "part").withColumn("block", F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1)
    return blocks.join(numbers.select("key", "block"), "key").drop("key")


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components as doubles."""
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["matrix"], row["kind"]).reshape(row["n"], row["dims"]).astype(np.float64)


def _largest(m: np.ndarray) -> np.ndarray:
    return np.abs(m).max(axis=1, initial=0)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products, exact, as 64-bit integers; beyond those the nearest one."""
    dims = min(q.shape[1], c.shape[1])
    q, c = q[:, :dims], c[:, :dims]
    of_q, of_c = _largest(q), _largest(c)
    out = np.zeros((len(q), len(c)), np.int64)
    if float(of_q.max(initial=0)) * float(of_c.max(initial=0)) * max(dims, 1) < 2.0**53:
        return (q @ c.T).astype(np.int64)
    # Few vectors are large as a rule: only what meets one of those is taken apart.
    small = (2.0**53 / max(dims, 1)) ** 0.5 * (1 - 1e-9)
    for rows in (np.flatnonzero(of_q < small), np.flatnonzero(of_q >= small)):
        for cols in (np.flatnonzero(of_c < small), np.flatnonzero(of_c >= small)):
            if not len(rows) or not len(cols):
                continue
            a, b = q[rows], c[cols]
            top = float(of_q[rows].max()) * float(of_c[cols].max()) * max(dims, 1)
            if top < 2.0**53:
                part = (a @ b.T).astype(np.int64)
            elif top < 2.0**62:
                part = a.astype(np.int64) @ b.astype(np.int64).T
            else:
                whole = _integers(a) @ _integers(b).T
                part = np.maximum(np.minimum(whole, _MOST), _LEAST).astype(np.int64)
            out[np.ix_(rows, cols)] = part
    return out


def _integers(m: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    if len(score) > 4 * k:  # all that tie with the k-th stay
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
        return at[np.lexsort((ids[at], ~score[at]))[:k]]
    return np.lexsort((ids, ~score))[:k]


def _cells(meet: Callable[[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray], None], close: Callable[[list[dict]], Iterator[pa.RecordBatch]]):
    """Rows sorted by (cell, side), the queries' blocks first: each block of candidates meets each block of queries, then the cell's results go out."""

    def phase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["cell"] != cell:
                    yield from close(queries)
                    cell, queries = row["cell"], []
                if row["side"] == 0:
                    queries.append(row)
                    continue
                c_ids, c = _unpack(row)
                for held in queries:
                    meet(held, *_unpack(held), c_ids, c)
        yield from close(queries)

    return phase


def _first(k: int):
    def meet(held: dict, q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray) -> None:
        total = scores(q, c)
        total[q_ids[:, None] == c_ids] = _LEAST  # no bound; without k bounds a query has no cutoff
        if "best" in held:
            total = np.concatenate([held["best"], total], axis=1)
        held["best"] = np.partition(total, total.shape[1] - k, axis=1)[:, total.shape[1] - k :] if total.shape[1] > k else total

    def close(queries: list[dict]) -> Iterator[pa.RecordBatch]:
        for held in queries:
            if "best" in held:
                best = held["best"]
                names, bounds = np.repeat(np.frombuffer(held["ids"], np.int64), best.shape[1]), best.ravel()
                real = bounds > _LEAST
                yield pa.RecordBatch.from_arrays([pa.array(np.full(int(real.sum()), held["block"])), pa.array(names[real]), pa.array(bounds[real])], names=["block", "query_id", "bound"])

    return _cells(meet, close)


def above(q: np.ndarray, c: np.ndarray, cut: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], dict[str, int]]:
    """Of each query the candidates that reach its cutoff, and their scores (phases 2 and 3); counts of what was touched.

    For doubles only: every sum stays below 2**53.
    """
    dims = min(q.shape[1], c.shape[1])
    edges = [dims * i // LISTS for i in range(LISTS + 1)]
    q_parts, c_parts = ([m[:, a:b] for a, b in zip(edges, edges[1:])] for m in (q, c))
    q_len, c_len = (np.stack([np.sqrt((p * p).sum(axis=1)) for p in parts], axis=1) * (1 + 1e-9) for parts in (q_parts, c_parts))
    share = cut / LISTS
    heads, touched = [], 0
    for g in range(LISTS):
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(share <= 0, 0.0, share / q_len[:, g])
        order = np.argsort(-c_len[:, g], kind="stable")
        n = int(np.searchsorted(-c_len[order, g], -float(np.nan_to_num(least, nan=0.0, posinf=np.inf).min(initial=np.inf)), side="right"))
        heads.append(order[:n])
        touched += n * len(q)
    if all(len(at) == len(c) for at in heads):  # every list is asked for to its end
        total = q[:, :dims] @ c[:, :dims].T
        ok = total >= cut[:, None]
        found = [np.flatnonzero(x) for x in ok]
        return found, [t[at].astype(np.int64) for t, at in zip(total, found)], {"entries": touched, "touched": touched, "collected": int(ok.sum()), "looked_up": 0}
    lists = [(at, q_parts[g] @ c_parts[g][at].T) for g, at in enumerate(heads)]
    known, bound, enough = np.zeros((len(q), len(c))), np.zeros((len(q), len(c))), np.zeros((len(q), len(c)), bool)
    for g, (at, part) in enumerate(lists):
        # What a missing entry can be at most: under the uniform share, and under its list's bound.
        most = np.minimum(np.ceil(share)[:, None], np.ceil(q_len[:, g][:, None] * c_len[None, :, g]))
        hit = part >= share[:, None]
        most[:, at] = np.where(hit, part, np.minimum(most[:, at], np.ceil(share)[:, None]))
        enough[:, at] |= hit
        known[:, at] += part
        bound += most
    ok = enough & (bound >= cut[:, None])
    found, values, asked = [], [], 0
    inside = np.zeros((LISTS, len(c)), bool)
    for g, (at, _) in enumerate(lists):
        inside[g, at] = True
    for i in range(len(q)):
        at = np.flatnonzero(ok[i])
        total = known[i, at]
        for g in range(LISTS):
            rest = np.flatnonzero(~inside[g, at])
            if len(rest):
                total[rest] += c_parts[g][at[rest]] @ q_parts[g][i]
                asked += len(rest)
        keep = total >= cut[i]
        found.append(at[keep])
        values.append(total[keep].astype(np.int64))
    return found, values, {"entries": LISTS * len(q) * len(c), "touched": touched, "collected": int(ok.sum()), "looked_up": asked}


def _rest(k: int):
    def meet(held: dict, q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray) -> None:
        cutoffs = {x["query_id"]: x["cutoff"] for x in held["cutoffs"] or []}
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(min(q.shape[1], c.shape[1]), 1) < 2.0**52
        parts = held.setdefault("found", [])
        for lo in range(0, len(q_ids), STRIP):
            names, part = q_ids[lo : lo + STRIP], q[lo : lo + STRIP]
            cut = np.array([cutoffs.get(x, _LEAST) for x in names.tolist()], np.int64)  # fewer than k candidates in all: every one is in the answer
            if exact and (cut > _LEAST).all():
                found, values, _ = above(part, c, cut.astype(np.float64))
            else:
                total = scores(part, c)
                found = [np.flatnonzero(t >= x) for t, x in zip(total, cut)]
                values = [t[at] for t, at in zip(total, found)]
            for query, at, value in zip(names.tolist(), found, values):
                other = c_ids[at] != query
                at, value = at[other], value[other]
                if len(at):
                    best = _best(c_ids[at], value, k)
                    parts.append((np.full(len(best), query), c_ids[at[best]], value[best]))
        if len(parts) > 100 * QUERIES:
            held["found"] = [_top(parts, k)]

    def close(queries: list[dict]) -> Iterator[pa.RecordBatch]:
        for held in queries:
            if held.get("found"):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _top(held["found"], k)], names=["query_id", "vec_id", "score"])

    return _cells(meet, close)


def _top(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, id, score) the k best of each query."""
    query, ids, score = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((ids, ~score, query))
    at = np.arange(len(order))
    first = np.concatenate([[True], query[order][1:] != query[order][:-1]])
    order = order[at - np.maximum.accumulate(np.where(first, at, 0)) < k]
    return query[order], ids[order], score[order]


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; ``is_query`` is a condition on vec_id."""
    rows = materialize(usable(vectors, vec_id, vector), "topk-vectors")
    spark = rows.sparkSession
    c = materialize(_numbered(rows.mapInArrow(_pack(CANDIDATES, k), _BLOCK), "topk-candidates"), "topk-numbered")
    q = materialize(_numbered(rows.where(is_query).repartition(F.shiftright("vec_id", 15)).mapInArrow(_pack(QUERIES, None), _BLOCK), "topk-queries"), "topk-numbered")
    n_q, n_c = q.count(), c.count()
    if not n_q or not n_c:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Few groups of queries, and so many of candidates that all cores have cells.
    groups_q = -(-n_q // QUERY_GROUP)
    per_c = max(1, min(CANDIDATE_GROUP, n_c * groups_q // (CELLS * spark.sparkContext.defaultParallelism)))
    groups_c = -(-n_c // per_c)
    cutoff = "array<struct<query_id: bigint, cutoff: bigint>>"

    def cells(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        mine = candidates.withColumn("side", F.lit(1)).withColumn("cutoffs", F.lit(None).cast(cutoff)).withColumn("_q", F.explode(F.expr(f"sequence(0L, {groups_q - 1}L)"))).withColumn("_c", F.expr(f"block div {per_c}"))
        theirs = queries.withColumn("side", F.lit(0)).withColumn("_q", F.expr(f"block div {QUERY_GROUP}")).withColumn("_c", F.explode(F.expr(f"sequence(0L, {groups_c - 1}L)")))
        both = mine.unionByName(theirs).withColumn("cell", F.col("_c") * groups_q + F.col("_q")).drop("_c", "_q")
        return both.repartition(min(4 * groups_q * groups_c, 4000), "cell").sortWithinPartitions("cell", "side")

    bounds = cells(q.withColumn("cutoffs", F.lit(None).cast(cutoff)), c.mapInArrow(_only_heads, c.schema)).mapInArrow(_first(k), "block long, query_id long, bound long")
    bounds = materialize(bounds, "topk-bounds")
    best = bounds.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound")))).where(F.col("r") <= k)
    reached = best.groupBy("query_id").agg(F.min("bound").alias("cutoff"), F.count("*").alias("n")).where(F.col("n") == k).select("query_id", "cutoff")
    # The rows of one query id can lie in several blocks; all get the same cutoff.
    where = bounds.select("block", "query_id").distinct()
    cutoffs = where.join(reached, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "cutoff")).alias("cutoffs"))
    q = materialize(q.join(cutoffs, "block", "left"), "topk-cutoffs")
    found = cells(q, c).mapInArrow(_rest(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
