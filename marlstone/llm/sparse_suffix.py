"""Repeated passages by sparse suffix arrays.

Texts are sequences of words, compared by 64-bit hashes. Suffixes are kept only where a word
position holds the smallest hash of ``SEED_WORDS`` words among ``WINDOW`` neighbours, so any
two places with the same words keep the same suffixes. Any passage of ``MIN_WORDS`` words has
such a position among its first ``WINDOW``, with ``KEY_WORDS`` or more words of the passage
after it.

1. Suffixes whose first KEY_WORDS words occur once in the corpus have no partner and are left
   out: counts of hashed keys, combined before they are shuffled.
2. The others get their context, words before and after the key, and are sorted by it: a
   distributed suffix array, dealt into ranges of the key and, within one, of a hash of the
   place, so that a frequent passage spreads over many tasks and bounds are two numbers.
3. Each suffix is compared with its neighbours from other texts; common words extend the match
   right and left. If it has MIN_WORDS words, its place is marked as repeated. Marked places of
   a text merge to spans.
4. Among three or more suffixes of a key the partner that shares most may not be a neighbour.
   There the passages of MIN_WORDS words around the places are compared by hash: within a
   task, and across tasks for the keys at the ends of a range. So the marked words are exactly
   those of passages that two different texts have, but for collisions of 64-bit hashes (32-bit
   for single words of context).

Every marked place names one text that has its passage too; of those of a document the one with
the smallest hash is its partner.

Equal texts are compared once and all get the spans of their text; with MIN_WORDS words or more
they are repeats of each other as a whole. Rows find their text's spans by a join in which texts
with many copies are broadcast.

Cases: a null, empty or short text has no passage and gives no row. Texts of any length are read
whole. Rows with the same id and text give a row each. A null id can't be named as the copied
one or the partner unless no other is there. Of equally placed suffixes all are compared; which of several
texts is a partner depends on their hashes alone where all lie in one range. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import give_back, map_texts, mix, powers, raw, slices, window_hashes, word_hashes, words
from marlstone.llm.spread import join_spread
from marlstone.storage import materialize

MIN_WORDS = 50
WINDOW, SEED_WORDS = 25, 5
KEY_WORDS = MIN_WORDS - WINDOW + 1
#: Words of context that are compared before a suffix and after its key.
LEFT, RIGHT = WINDOW - 1, MIN_WORDS - KEY_WORDS + 1
#: Suffixes of one key that a task compares together.
HELD = 40_000
_ALIKE = 40  # bits of a seed's hash that order it; the rest hold its place, so the first of equals is taken

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _sliding(v: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over v[i : i + width] for every i with a whole window."""
    out, done = v, 1
    while done * 2 <= width:
        out, done = pick(out[:-done], out[done:]), done * 2
    return pick(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def selected(h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Positions of one text's words ``h`` at which suffixes are kept; a key must fit."""
    n = len(h) - SEED_WORDS + 1
    if len(h) < MIN_WORDS:
        return np.zeros(0, np.int64)
    v = (seeds[:n] >> np.uint64(64 - _ALIKE) << np.uint64(64 - _ALIKE)) | (np.arange(n, dtype=np.uint64) & np.uint64((1 << (64 - _ALIKE)) - 1))
    low = _sliding(v, WINDOW, np.minimum)
    least = _sliding(np.concatenate([np.zeros(WINDOW - 1, np.uint64), low, np.zeros(WINDOW - 1, np.uint64)]), WINDOW, np.maximum)
    at = np.flatnonzero(least == v)
    return at[at + KEY_WORDS <= len(h)]


def _hashed(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw(part.column(part.schema.get_field_index(text)))
    start, end, first = words(data, offsets)
    return word_hashes(data, start, end), first


def _keys(docs: DataFrame) -> DataFrame:
    """n_words, and the distinct keys of the kept suffixes with their positions, of each text."""

    def work():
        def one(part: pa.RecordBatch) -> dict:
            h, first = _hashed(part, "text")
            seeds, keys = window_hashes(h, SEED_WORDS), window_hashes(h, KEY_WORDS)
            at = [selected(h[a:b], seeds[a:b]) for a, b in zip(first[:-1], first[1:])]
            flat = np.concatenate([np.zeros(0, np.int64), *[x + a for x, a in zip(at, first)]])
            owner = np.repeat(np.arange(len(at)), [len(x) for x in at])
            order = np.lexsort((flat, keys[flat], owner))
            flat, owner = flat[order], owner[order]
            key = keys[flat]
            heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])) if len(flat) else np.zeros(0, np.int64)
            outer = np.searchsorted(owner[heads], np.arange(len(at) + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(np.append(heads, len(flat)).astype(np.int32)), pa.array((flat - first[owner]).astype(np.int32)))
            return {
                "n_words": pa.array(np.diff(first).astype(np.int64)),
                "keys": pa.ListArray.from_arrays(pa.array(outer), pa.array(key[heads].view(np.int64))),
                "at": pa.ListArray.from_arrays(pa.array(outer), places),
            }

        return one

    fields = [T.StructField("n_words", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("at", T.ArrayType(T.ArrayType(T.IntegerType())))]
    return map_texts(docs, "text", fields, work, without=("text",))


_SUFFIX = "key long, right binary, left binary, digest binary, at int"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, text, at) to a row for each suffix with its context, as big-endian 32-bit word hashes; 0 beyond the text."""
    for batch in batches:
        for part in slices(batch, "text"):
            h, first = _hashed(part, "text")
            keys = window_hashes(h, KEY_WORDS)
            short = np.maximum(h >> np.uint64(32), np.uint64(1)).astype(">u4")
            at = part.column(part.schema.get_field_index("at")).to_pylist()
            digests = part.column(part.schema.get_field_index("digest")).to_pylist()
            for i, places in enumerate(at):
                a, b = int(first[i]), int(first[i + 1])
                padded = np.concatenate([np.zeros(LEFT, ">u4"), short[a:b], np.zeros(RIGHT, ">u4")])
                for lo in range(0, len(places), 20_000):
                    p = np.sort(np.array(places[lo : lo + 20_000], np.int64))
                    right = padded[(p + LEFT + KEY_WORDS)[:, None] + np.arange(RIGHT)]
                    left = padded[(p + LEFT - 1)[:, None] - np.arange(LEFT)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[a + p].view(np.int64)), _fixed(right), _fixed(left), pa.array([digests[i]] * len(p), pa.binary()), pa.array(p.astype(np.int32))],
                        names=["key", "right", "left", "digest", "at"],
                    )
        give_back()


def _fixed(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1] * 4), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns agree in each row; 0 ends a text."""
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), a.shape[1], (~same).argmax(axis=1))


#: A marked place has start, end and the number of a text it is met in; a passage to be met has its hash, the words before its places, and those.
_MARKS = "digest binary, start int, end int, other long, window long, before int, places array<int>"
_NAMES = ["digest", "start", "end", "other", "window", "before", "places"]


def _numbers(digests: list[bytes]) -> pa.Array:
    """The number of each text, as Spark's xxhash64 gives it."""
    made: dict[bytes, int] = {}
    for d in digests:
        if d not in made:
            made[d] = xxhash.xxh64_intdigest(d, 42)
    return pa.array(np.array([made[d] for d in digests], np.uint64).view(np.int64))


def _extended(rows: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that suffixes ``one`` have in common with suffixes ``two`` before and from their place; whether that is a passage."""
    key, right, left, _, _ = rows
    r = np.where(key[one] == key[two], KEY_WORDS + _common(right[one], right[two]), 0)
    l = np.where(r > 0, _common(left[one], left[two]), 0)
    return l, r, r + l >= MIN_WORDS


def _windows(rows: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of words before the place: the hash of the passage of MIN_WORDS words that starts there, and where it fits."""
    key, right, left, _, _ = rows
    before = np.concatenate([np.zeros((len(key), 1), np.uint64), np.cumsum(left.astype(np.uint64) * powers(LEFT), axis=1, dtype=np.uint64)], axis=1)
    after = np.concatenate([np.zeros((len(key), 1), np.uint64), np.cumsum(right.astype(np.uint64) * powers(RIGHT), axis=1, dtype=np.uint64)], axis=1)
    room_before, room_after = (np.where((x != 0).all(axis=1), x.shape[1], (x == 0).argmax(axis=1)) for x in (left, right))
    for l in range(WINDOW):
        m = MIN_WORDS - KEY_WORDS - l
        h = mix(mix(key.view(np.uint64)) + mix(before[:, l] + np.uint64(l)) * np.uint64(3) + mix(after[:, m]) * np.uint64(5))
        yield l, h, (room_before >= l) & (room_after >= m)


def _in_two_texts(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where another text has the same hash, or -1."""
    if not len(h):
        return np.zeros(0, np.int64)
    order = np.lexsort((text, h))
    hs, ts = h[order], text[order]
    new = np.concatenate([[True], hs[1:] != hs[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(h)) - 1
    first, last = (np.repeat(x, last - first + 1) for x in (first, last))
    other = np.where(ts[first] != ts, first, last)
    out = np.empty(len(h), np.int64)
    out[order] = np.where(ts[other] != ts, order[other], -1)
    return out


def _matches(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each suffix's repeated words, end 0 where there are none, and a suffix of another text that has some; ``rows`` are sorted and hold whole groups of a key."""
    key, _, _, digest, at = rows
    n = len(key)
    start, end, met = at.astype(np.int64).copy(), np.zeros(n, np.int64), np.full(n, -1)
    # Neighbours: suffixes of one text in a row form a run, which meets the nearest suffix of another text on either side.
    turn = np.concatenate([[True], (digest[1:] != digest[:-1]) | (key[1:] != key[:-1])])
    where = np.flatnonzero(turn)
    run = np.cumsum(turn) - 1
    for other in (where[run] - 1, np.append(where[1:], n)[run]):
        one = np.flatnonzero((other >= 0) & (other < n))
        if len(one):
            l, r, ok = _extended(rows, one, other[one])
            one, l, r = one[ok], l[ok], r[ok]
            start[one], end[one], met[one] = np.minimum(start[one], at[one] - l), np.maximum(end[one], at[one] + r), other[one]
    # Among three or more, a partner with fewer words after the place but more before it may not be a neighbour.
    group = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(group, n))
    more = np.flatnonzero(np.repeat(size > 2, size))
    if len(more):
        part = [c[more] for c in rows]
        text = np.unique(part[3], return_inverse=True)[1]
        for l, h, fits in _windows(part):
            hit = np.flatnonzero(fits)
            other = _in_two_texts(h[hit], text[hit])
            two = other >= 0
            hit, other = more[hit[two]], more[hit[other[two]]]
            start[hit], end[hit], met[hit] = np.minimum(start[hit], at[hit] - l), np.maximum(end[hit], at[hit] - l + MIN_WORDS), other
    return start, end, met


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range of suffixes to marked places (window null).

    The first and the last key of a range may go on in other ranges, and a key's group may be
    too large to hold; those suffixes also give the hashes of their passages, to be met elsewhere.
    """
    held: list[np.ndarray] | None = None
    going_on: list[int] = []  # the range's first key, and the last one that was too large to hold

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        right, left = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u4").reshape(batch.num_rows, -1) for i in (1, 2))
        return [batch.column(0).to_numpy(zero_copy_only=False), right, left, np.array(batch.column(3).to_pylist(), object), batch.column(4).to_numpy(zero_copy_only=False)]

    def marked(rows: list[np.ndarray]) -> pa.RecordBatch:
        start, end, met = _matches(rows)
        ok = np.flatnonzero(end)
        none = [pa.nulls(len(ok), kind) for kind in (pa.int64(), pa.int32(), pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array(rows[3][ok].tolist(), pa.binary()), pa.array(start[ok].astype(np.int32)), pa.array(end[ok].astype(np.int32)), _numbers(rows[3][met[ok]].tolist()), *none], names=_NAMES)

    def passages(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Hashes to be met elsewhere, a row for each text that has one, with all its places.

        What two texts have here is marked already: two texts with a place each stand for them,
        so that either text meets the other wherever else it has the passage.
        """
        text = np.unique(rows[3], return_inverse=True)[1]
        for l, h, fits in _windows(rows):
            hit = np.flatnonzero(fits)
            if not len(hit):
                continue
            hit = hit[np.lexsort((text[hit], h[hit]))]
            hs, ts = h[hit], text[hit]
            new = np.concatenate([[True], hs[1:] != hs[:-1]])
            heads = np.flatnonzero(new | np.concatenate([[True], ts[1:] != ts[:-1]]))
            group = np.cumsum(new)[heads]
            opens, ends = np.concatenate([[True], group[1:] != group[:-1]]), np.concatenate([group[1:] != group[:-1], [True]])
            size = np.where(opens & ends, np.diff(np.append(heads, len(hit))), 1)
            given = opens | ends
            heads, size = heads[given], size[given]
            first = np.concatenate([[0], np.cumsum(size)])
            places = rows[4][hit[np.repeat(heads - first[:-1], size) + np.arange(first[-1])]].astype(np.int32)
            none = pa.nulls(len(heads), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[3][hit[heads]].tolist(), pa.binary()), none, none, pa.nulls(len(heads), pa.int64()), pa.array(hs[heads].view(np.int64)), pa.array(np.full(len(heads), l, np.int32)), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(places))],
                names=_NAMES,
            )

    def done(rows: list[np.ndarray], whole: bool) -> Iterator[pa.RecordBatch]:
        yield marked(rows)
        open_ = np.isin(rows[0], going_on) if whole else np.ones(len(rows[0]), bool)
        if open_.any():
            yield from passages([c[open_] for c in rows])

    for batch in batches:
        for lo in range(0, batch.num_rows, HELD // 4):
            rows = columns(batch.slice(lo, HELD // 4))
            going_on = going_on or [rows[0][0]]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            cut = int(np.searchsorted(rows[0] == rows[0][-1], True))  # where the last key's group begins
            if cut:
                yield from done([c[:cut] for c in rows], True)
            held = [c[cut:] for c in rows]
            if len(held[0]) > HELD:
                yield from done(held, False)
                going_on, held = [going_on[0], held[0][0]], None
    if held is not None:
        yield from done(held, False)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, other, places) to disjoint spans; spans that touch join."""
    for batch in batches:
        lists = batch.column(2)
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        flat = lists.flatten()
        start, end = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        row = np.repeat(np.arange(len(lists)), np.diff(at))
        order = np.lexsort((start, row))
        start, end = start[order], end[order]
        shift = row << 33  # keeps rows apart, so that one running maximum serves all
        reach = np.maximum.accumulate(end + shift) - shift
        new = np.ones(len(start), bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
        heads = np.flatnonzero(new)
        spans = pa.StructArray.from_arrays([pa.array(start[heads]), pa.array(reach[np.append(heads[1:], len(start)) - 1] if len(start) else start)], names=["start", "end"])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(np.searchsorted(row[heads], np.arange(len(lists) + 1)).astype(np.int32)), spans)], names=["digest", "other", "spans"])


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document with a repeated passage: doc_id, n_words, dup_words, spans (of words, end exclusive), partner, copy_of, copies.

    ``copy_of`` is the smallest id of an equal text, if other rows have it, and ``copies`` their
    number, this one included. ``partner`` is the smallest id of a different text that shares a
    passage; copies without one have none.
    """
    digest_of = F.unhex(F.md5("text"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = materialize(_keys(rows.withColumn("digest", digest_of)).where(F.col("n_words") >= MIN_WORDS), "suffix-keys")
    text_no = F.xxhash64("digest")  # a number, so that the aggregates are hashed and not sorted
    same = materialize(found.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("n_words").alias("n_words")), "suffix-texts")
    once = join_spread(found.drop("n_words"), same.select("digest", "first_id", "copies"), ["digest"], "copies").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    once = once.select("digest", "doc_id", F.explode(F.arrays_zip("keys", "at")).alias("s")).select("digest", "doc_id", F.col("s.keys").alias("key"), F.col("s.at").alias("at"))
    shared = once.groupBy("key").agg(F.min(text_no).alias("a"), F.max(text_no).alias("b")).where(F.col("a") != F.col("b")).select(F.col("key").alias("k"))
    kept = once.join(shared, F.col("key") == F.col("k"), "left_semi")
    places = materialize(kept.groupBy("digest", F.col("doc_id").alias("of")).agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")), "suffix-places")
    texts = rows.withColumn("d", digest_of).join(places, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("d") == F.col("digest"))).select("digest", "text", "at")
    suffixes = materialize(texts.mapInArrow(_contexts, _SUFFIX), "suffix-contexts")
    order = ["key", "right", "left", "digest", "at"]
    ordered = suffixes.repartitionByRange("key", F.xxhash64("digest", "at")).sortWithinPartitions(*order)
    marks = materialize(ordered.mapInArrow(_neighbours, _MARKS), "suffix-marks")
    spans = marks.where("window is null").select("digest", "start", "end", "other")
    met = marks.where("window is not null")
    twice = met.groupBy("window").agg(F.min(text_no).alias("a"), F.max(text_no).alias("b")).where(F.col("a") != F.col("b")).select(F.col("window").alias("w"), "a", "b")
    found_far = met.join(twice, F.col("window") == F.col("w")).select("digest", "before", F.when(F.col("a") == text_no, F.col("b")).otherwise(F.col("a")).alias("other"), F.explode("places").alias("at"))
    found_far = found_far.groupBy("digest", "at").agg(F.min(F.col("at") - F.col("before")).alias("start"), F.max(F.col("at") - F.col("before") + MIN_WORDS).alias("end"), F.min("other").alias("other"))
    spans = spans.union(found_far.select("digest", "start", "end", "other"))
    spans = spans.groupBy("digest").agg(F.min("other").alias("other"), F.collect_set(F.struct("start", "end")).alias("places"))
    merged = materialize(spans.mapInArrow(_merged, T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("other", T.LongType()), T.StructField("spans", SPANS)])), "suffix-spans")
    asked = merged.groupBy("other").agg(F.count("*").alias("n"))
    named = asked.join(same.groupBy(text_no.alias("other")).agg(F.min("first_id").alias("partner")), "other")
    merged = join_spread(merged, named, ["other"], "n").drop("other")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    out = same.join(merged, "digest", "left").select("digest", "first_id", "partner", "copies", F.when(F.col("copies") > 1, whole).otherwise(F.col("spans")).alias("spans"), F.col("copies").alias("n")).where("spans is not null")
    dup = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return join_spread(found.select("doc_id", "n_words", "digest"), materialize(out, "suffix-found"), ["digest"], "n").select(
        "doc_id", "n_words", dup.alias("dup_words"), "spans", "partner", F.when(F.col("copies") > 1, F.col("first_id")).alias("copy_of"), "copies"
    )
