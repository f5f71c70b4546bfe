"""SimHash near-duplicates with pigeonring filtering.

The 64 bits lie on a ring of five segments (13, 13, 13, 13 and 12 bits). If two fingerprints
differ in at most four bits, there is a segment from which every chain of 1, 2, .. 5
consecutive segments differs in at most 0.8, 1.6, .. 4 bits altogether (the strong form of
the pigeonhole principle on a ring; Qin and Xiao, Pigeonring, 2018). So the segment itself
must be equal and the next may differ in one bit. That chain of two is the index: a bucket
holds the fingerprints that agree in a segment and, but for one left-out bit, in the next.
Inside a bucket the longer chains are checked against their budgets, then the whole distance.

Fingerprints that occur often count once. A bucket gives the links of a spanning forest, found
by growing each component from a seed, never all its pairs. Buckets above ``BUCKET`` are cut
into parts, and each pair of parts is worked on by itself.

Rows find their fingerprint's component by a join in which fingerprints with many rows are
broadcast, so that no task gathers a group of copies.

Cases: a null or wordless text has fingerprint zero and links like any other. A component's id
is its smallest non-null doc_id. Rows with equal ids or texts all stay. Texts of any length are
read whole. An empty table gives no rows. Other columns are not read, or, where rows are kept or
left out, kept as they are whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marlstone.llm import shingle_bands
from marlstone.llm.batches import map_texts, raw
from marlstone.llm.spread import join_spread
from marlstone.operators.components import connected_components
from marlstone.storage import materialize

SHINGLE, SEED, DISTANCE = 4, 42, 4
SEGMENTS = (13, 13, 13, 13, 12)
#: Fingerprints of a bucket that are worked on together.
BUCKET = 1024

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SHIFT = np.cumsum((0, *SEGMENTS[:-1])).astype(np.uint64)
_WIDTH = np.array(SEGMENTS, np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's UTF-8 bytes."""
    tokens = text.translate(_LOWER).split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    n = len(tokens) - shingle + 1
    if n <= 1:
        return digest(line, SEED)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    end = np.cumsum(size)
    start = (end - size)[:n].tolist()
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(start, (end - 1)[shingle - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", bands: int | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, but not ``without``, with the fingerprint as a signed long in column ``name``; with ``bands`` also the keys of its shingles of so many words."""
    fields = [T.StructField(name, T.LongType())] + ([shingle_bands.BANDS_FIELD] if bands else [])

    def work():
        more = shingle_bands.bands_of(text, bands)() if bands else lambda part: {}

        def one(part: pa.RecordBatch) -> dict:
            data, offsets = raw(part.column(part.schema.get_field_index(text)))
            whole = data.tobytes()
            found = [fingerprint(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return {name: pa.array(np.array(found, np.uint64).view(np.int64))} | more(part)

        return one

    return map_texts(docs, text, fields, work, without=without)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of fingerprints: (n x 65) keys, and for each column its segment on the ring."""
    out, column = [], []
    m = len(SEGMENTS)
    part = [(fps >> _SHIFT[i]) & ((np.uint64(1) << _WIDTH[i]) - np.uint64(1)) for i in range(m)]
    for i in range(m):
        j = (i + 1) % m
        for bit in range(SEGMENTS[j]):
            b = np.uint64(bit)
            low = part[j] & ((np.uint64(1) << b) - np.uint64(1))
            rest = ((part[j] >> (b + np.uint64(1))) << b) | low
            out.append((part[i] << np.uint64(12)) | rest | np.uint64((i * 16 + bit) << 32))
            column.append(i)
    return np.stack(out, axis=1), np.array(column)


def chains_hold(x: np.ndarray, start: int) -> np.ndarray:
    """Of the bit differences x: whether the chains of every length from ``start`` keep their budgets."""
    ok, total, m = np.ones(x.shape, bool), np.zeros(x.shape, np.int64), len(SEGMENTS)
    for length in range(1, m + 1):
        i = (start + length - 1) % m
        mask = ((np.uint64(1) << _WIDTH[i]) - np.uint64(1)) << _SHIFT[i]
        total = total + np.bitwise_count(x & mask)
        ok &= total * m <= DISTANCE * length
    return ok


def forest(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Spanning links of the components of one bucket, by the chains from segment ``start``.

    A component grows from a seed; every reached member is compared with the unreached ones
    once.
    """
    rest, links = fps.copy(), []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = chains_hold(rest ^ x, start)
            if near.any():
                hit = rest[near]
                links += [(int(x), int(y)) for y in hit]
                front += list(hit)
                rest = rest[~near]
    return links


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
            found, _ = keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), pa.array(np.repeat(fps, found.shape[1]).view(np.int64))], names=["key", "fp"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, cell, fp) to links; a task's links go through one union-find, so each joins two sets."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    us: list[int] = []
    vs: list[int] = []

    def bucket(key: int, fps: np.ndarray) -> None:
        fps = np.unique(fps)
        if len(fps) > 1:
            for a, b in forest(fps, int(key) >> 36):
                ra, rb = find(a), find(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    us.append(a)
                    vs.append(b)

    held: tuple | None = None
    kept: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, cell = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        change = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
        edges = np.concatenate([[0], change, [len(key)]])
        size = np.diff(edges)
        last = len(size) - 1
        for g in np.flatnonzero((size > 1) | (np.arange(len(size)) == 0) | (np.arange(len(size)) == last)):
            a, b = edges[g], edges[g + 1]
            name = (key[a], cell[a])
            if g == 0 and held is not None and held != name:
                bucket(held[0], np.concatenate(kept))
                kept = []
            if g == last:
                kept = kept if held == name else []
                kept.append(fps[a:b].copy())
                held = name
            elif g == 0 and held == name:
                bucket(key[a], np.concatenate([*kept, fps[a:b]]))
                kept, held = [], None
            else:
                bucket(key[a], fps[a:b])
        if len(us) > 50_000:
            yield _pairs(us, vs)
    if kept:
        bucket(held[0], np.concatenate(kept))
    yield _pairs(us, vs)


def _pairs(us: list[int], vs: list[int]) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (us, vs)], names=["u", "v"])
    us.clear()
    vs.clear()
    return out


def links(fps: DataFrame) -> DataFrame:
    """u, v: links that connect all fingerprints (column fp, distinct) within the distance."""
    rows = fps.select("fp").mapInArrow(_explode, "key long, fp long")
    # A bucket is at most as large as the fingerprints that agree in both its segments in
    # either value of the left-out bit; counting those takes five rows a fingerprint.
    m = len(SEGMENTS)
    spots = []
    for i in range(m):
        j = (i + 1) % m
        one, two = (F.shiftrightunsigned("fp", int(_SHIFT[x])).bitwiseAND((1 << SEGMENTS[x]) - 1) for x in (i, j))
        spots.append(F.struct(F.lit(i).alias("i"), one.alias("a"), two.alias("b")))
    counts = fps.select(F.explode(F.array(*spots)).alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET // 2)
    bits = F.explode(F.expr(f"sequence(0, element_at(array({','.join(map(str, SEGMENTS))}), (s.i + 1) % {m} + 1) - 1)"))
    large = counts.select("s", "n", bits.alias("bit"))
    low = F.expr("s.b & (shiftleft(1, bit) - 1)")
    left = F.expr("shiftleft(shiftright(s.b, bit + 1), bit)")
    key = F.expr("shiftleft(s.a, 12)").bitwiseOR(left.cast("long")).bitwiseOR(low.cast("long")).bitwiseOR(F.expr("shiftleft(cast(s.i * 16 + bit as bigint), 32)"))
    large = large.groupBy(key.alias("big")).agg(F.sum("n").alias("n")).where(F.col("n") > BUCKET).select("big", F.ceil(F.col("n") * 2 / BUCKET).cast("int").alias("parts"))
    large = materialize(large, "simhash-large")
    rows = rows.join(large, F.col("key") == F.col("big"), "left")
    own = F.expr("cast(pmod(xxhash64(fp), parts) as int)")
    # Part p of a large bucket meets every part q in the cell of the unordered pair (p, q).
    cells = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.expr("sequence(0, parts - 1)"), lambda q: F.least(q, own).cast("long") * F.col("parts") + F.greatest(q, own)))
    dealt = rows.select("key", F.explode(cells).alias("cell"), "fp")
    dealt = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
    return dealt.mapInArrow(_links, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = materialize(with_fingerprints(rows, without=("text",)), "simhash-rows")
    of = materialize(_labels(rows), "simhash-labels")
    lowest = of.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("size"))
    ids = materialize(join_spread(of, lowest, ["component"], "size").select("fp", "component_id", "n"), "simhash-ids")
    return join_spread(rows, ids, ["fp"], "n").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _labels(rows: DataFrame, few: int = 0) -> DataFrame:
    """fp, first_id (its smallest doc_id), n (its rows) and component of every fingerprint in ``rows``; up to ``few`` links by one task."""
    first = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "simhash-distinct")
    found = connected_components(links(first), "simhash-links", few)
    return first.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", "n", F.coalesce("component", "fp").alias("component"))


def _labels_alike(rows: DataFrame, texts: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Like _labels, and components that hold texts of the similarity are one; ``rows`` have digest and bands too."""
    of = materialize(_labels(rows, shingle_bands.FEW_LINKS), "simhash-labels")
    once = rows.groupBy("digest").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    banded = materialize(join_spread(once, of.select("fp", F.col("component").alias("group"), "n"), ["fp"], "n").select(F.xxhash64("digest").alias("id"), "group", "bands"), "bands")
    texts = texts.select(F.xxhash64("digest").alias("id"), "text")
    found = connected_components(shingle_bands.links(banded, texts, similarity, shingle), "shingle-links", shingle_bands.FEW_LINKS).withColumnRenamed("component", "whole")
    return of.join(found, F.col("component") == F.col("node"), "left").select("fp", "first_id", F.coalesce("whole", "component").alias("component"))


def _row_key(doc_id: F.Column, digest: F.Column) -> F.Column:
    return F.concat(digest, F.coalesce(doc_id.cast("string"), F.lit("null")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float | None = None, shingle: int = shingle_bands.SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, then the smallest digest of its text.

    With ``similarity``, texts whose shingles of ``shingle`` words have that Jaccard similarity
    are linked too, however far apart their fingerprints are.
    Rows without an id stay only in components that hold no id. Of rows with the same id and
    text one stays.
    """
    safe = {c: f"in{i}" for i, c in enumerate(docs.columns)}  # names that nothing here has
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = texts = rows.withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    rows = materialize(with_fingerprints(rows, bands=None if similarity is None else shingle, without=("text",)), "simhash-rows")
    of = _labels(rows, shingle_bands.FEW_LINKS) if similarity is None else _labels_alike(rows, texts, similarity, shingle)
    of = of.select(F.col("fp").alias("of_fp"), "component")
    # A fingerprint's own best row first, so that copies are gone before the components meet.
    own = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("best"))
    best = own.join(of, F.col("fp") == F.col("of_fp")).groupBy("component").agg(F.min("best").alias("best"))
    # One plain key on either side, so that whole rows are shuffled once, for the join and the window alike.
    marks = best.select(_row_key(F.col("best.doc_id"), F.col("best.digest")).alias("_mark"))
    whole = docs.toDF(*safe.values())
    whole = whole.withColumn("_key", _row_key(F.col(safe[doc_id]).cast("long"), F.md5(F.coalesce(F.col(safe[text]).cast("string"), F.lit("")))))
    found = whole.join(marks, F.col("_key") == F.col("_mark"), "left_semi")
    one = Window.partitionBy("_key").orderBy(F.lit(1))
    return found.withColumn("_row", F.row_number().over(one)).where(F.col("_row") == 1).select(*safe.values()).toDF(*docs.columns)
