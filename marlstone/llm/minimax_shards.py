"""Sharding by a minimax contiguous partition, in DataFrame functions only.

Equal texts form an atomic group. Groups are ordered by their smallest doc_id and get running
sums of bytes. A binary search finds the smallest capacity at which greedy filling, group by
group in order, needs no more than the given number of shards. The groups are cut so that no
shard exceeds that capacity. Where one group alone decides it, the others are held to the least
size at which greedy filling still does, and each cut lies as near to an equal part of what is
left as that allows, so the last shards are no emptier than the first.

The running sums stay in a table. The driver knows a bounded set of them: for each of about
``BUCKETS`` equal stretches the first and the last running sum in it. A capacity is surely enough if greedy
cuts at known sums suffice, and surely too small if cuts anywhere inside unknown stretches
don't. Where neither holds, the stretches that the cuts can fall in are split again, so a few
passes give the exact capacity at any size. Cuts are made at known sums; these lie no farther
apart than a stretch or a group.

Rows find their group's shard by a join on the group. Groups of more than 1 / ``HOT`` of all
rows are fewer than ``HOT``, so they are broadcast, and their rows are never gathered.

Cases: a null text has no bytes (size 8, crc32 0) and is a group of its own, apart from the
empty text. Null ids come first. Rows that share an id or text all get a slot. Texts of any
length are measured whole, and a long one is never shuffled, only its digest. Fewer groups
than shards leave shards empty; one group larger than a fair share fills a shard alone. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.llm.spread import HOT, join_spread
from marlstone.storage import materialize

#: Stretches that a pass splits the undecided ranges into, at most.
BUCKETS = 4096
ROW_BYTES = 8


def rows_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the group key of every row, without its text."""
    t = F.col(text).cast("string")
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(t, 256)), F.lit(b"null")).alias("grp"),
    )


def running(df: DataFrame, order: list, add: list[str], name: str) -> DataFrame:
    """``df`` with <column>_upto, the sum of each column of ``add`` over all rows up to this one.

    Rows are dealt into ranges; sums run within a range, and the totals of the ranges before it
    (one row each) are added.
    """
    dealt = materialize(df.repartitionByRange(*order).withColumn("stretch", F.spark_partition_id()), name)
    within = Window.partitionBy("stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("stretch").agg(*[F.sum(c).alias(c) for c in add])
    bases = totals.select("stretch", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_base") for c in add])
    out = dealt.select("*", *[F.sum(c).over(within).alias(f"{c}_in") for c in add]).join(F.broadcast(bases), "stretch")
    return out.select(*df.columns, *[(F.col(f"{c}_in") + F.col(f"{c}_base")).alias(f"{c}_upto") for c in add])


class _Known:
    """Sorted running sums; ``solid[i]``: no other sum lies between point i - 1 and point i."""

    def __init__(self) -> None:
        self.points: list[int] = [0]
        self.solid: list[bool] = [True]

    def put(self, found: dict[int, bool]) -> None:
        merged = dict(zip(self.points, self.solid))
        for p, s in found.items():
            merged[p] = merged.get(p, False) or s
        self.points = sorted(merged)
        self.solid = [merged[p] for p in self.points]

    def reach(self, at: int, capacity: int, hopeful: bool) -> int:
        """The farthest cut from ``at``: among known sums, or where a hidden one might lie."""
        i = bisect_right(self.points, at + capacity) - 1
        if hopeful and i + 1 < len(self.points) and not self.solid[i + 1]:
            return at + capacity
        return self.points[i]

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            at = max(at, self.reach(at, capacity, hopeful))
            out.append(at)
        return out

    def fits(self, capacity: int, shards: int, hopeful: bool) -> bool:
        return self.cuts(capacity, shards, hopeful)[-1] >= self.points[-1]

    def soft(self, at: int, fair: int, capacity: int) -> int:
        """The farthest cut from ``at`` of a shard of ``fair`` bytes, or of the next known sum alone where that is more."""
        i = bisect_right(self.points, at)
        p = max(self.reach(at, fair, False), self.points[min(i, len(self.points) - 1)])
        return p if p - at <= capacity else at

    def level(self, capacity: int, shards: int) -> list[int]:
        """Cuts at known sums, no shard above the capacity.

        A group beyond a fair size has a shard to itself, so that size is the least with which
        greedy filling needs no more than ``shards``. Each cut then lies as near to an equal part
        of what is left as the shards behind it allow.
        """
        total = self.points[-1]

        def ends(fair: int) -> bool:
            at = 0
            for _ in range(shards):
                at = self.soft(at, fair, capacity)
            return at >= total

        low, fair = 1, capacity
        while low < fair:
            mid = (low + fair) // 2
            low, fair = (low, mid) if ends(mid) else (mid + 1, fair)
        needed = [total]
        for _ in range(shards - 1):  # the least sums from which the shards behind can still take what is left
            end = needed[-1]
            i, j = bisect_left(self.points, end - fair), bisect_left(self.points, end)
            needed.append(self.points[max(i if i < j else j - 1, 0)] if end else 0)
        at, out = 0, []
        for left, least in zip(range(shards, 1, -1), needed[:0:-1]):
            aim = at + (total - at) / left
            i = bisect_left(self.points, aim)
            best = min(self.points[max(i - 1, 0) : i + 1], key=lambda p: abs(p - aim), default=at)
            after = self.points[min(bisect_right(self.points, at), len(self.points) - 1)]
            at = min(max(best, least, after), self.soft(at, fair, capacity))
            out.append(at)
        return [*out, total]


def smallest_capacity(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity and the running sums at which shards end.

    ``groups`` has bytes and bytes_upto.
    """
    top = groups.agg(F.max("bytes_upto").alias("total"), F.max("bytes").alias("largest")).first()
    if top.total is None:
        return 0, [0] * shards
    known, total = _Known(), int(top.total)
    low, high = max(int(top.largest), -(-total // shards)), total
    ranges = [(0, total)]
    while True:
        _refine(groups, known, ranges)
        low, high = _search(known, shards, low, high, True), _search(known, shards, low, high, False)
        if low == high and known.cuts(low, shards, True) == known.cuts(low, shards, False):
            return low, known.level(low, shards)
        ranges = []
        for a, b in zip(known.cuts(low, shards, False), known.cuts(high, shards, True)):
            i, j = bisect_right(known.points, a) - 1, bisect_right(known.points, b)
            ranges += [(known.points[x - 1], known.points[x]) for x in range(max(i, 1), min(j, len(known.points) - 1) + 1) if not known.solid[x]]
        ranges = _joined(ranges)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(ranges)):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(known: _Known, shards: int, low: int, high: int, hopeful: bool) -> int:
    while low < high:
        mid = (low + high) // 2
        if known.fits(mid, shards, hopeful):
            high = mid
        else:
            low = mid + 1
    return low


def _refine(groups: DataFrame, known: _Known, ranges: list[tuple[int, int]]) -> None:
    """One pass: the first and last running sum of each stretch of each range (a, b], two stretches at least.

    ``ranges`` are sorted and disjoint. A sum's range is the number of lower bounds under it.
    """
    step = [max(1, min(-(-(b - a) * len(ranges) // BUCKETS), (b - a + 1) // 2)) for a, b in ranges]
    table = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"), F.lit(s).cast("long").alias("s")) for (a, b), s in zip(ranges, step)])
    p = F.col("bytes_upto")
    found = groups.select(p, F.size(F.filter(table, lambda r: r["a"] < p)).alias("r")).where("r > 0")
    found = found.select(p, "r", F.element_at(table, F.col("r")).alias("in")).where(p <= F.col("in.b"))
    found = found.groupBy("r", F.floor((p - F.col("in.a") - 1) / F.col("in.s")).alias("stretch")).agg(F.min(p).alias("first"), F.max(p).alias("last"), F.count("*").alias("n"))
    found = found.agg(*[F.collect_list(c).alias(c) for c in ("first", "last", "n")])  # at most BUCKETS and a few per range
    new: dict[int, bool] = {}
    for row in found.collect():
        for first, last, n in zip(row.first, row.last, row.n):
            new[last] = new.get(last, False) or n <= 2
            new[first] = True
    known.put(new)


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; sizes of shards are near equal."""
    rows = materialize(rows_of(docs, doc_id, text), "shard-rows")
    groups = rows.groupBy("grp").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = materialize(running(groups, [F.col("first_id"), F.col("grp")], ["bytes"], "shard-groups"), "shard-sums")
    _, cuts = smallest_capacity(groups, shards)
    ends = F.array(*[F.lit(c).cast("long") for c in cuts[:-1]])
    number = F.size(F.filter(ends, lambda c: c < F.col("bytes_upto")))
    placed = join_spread(rows, groups.select("grp", number.alias("shard"), "n"), ["grp"], "n").withColumn("one", F.lit(1).cast("long"))
    order = [F.col("shard"), F.col("doc_id"), F.col("grp")]
    ranked = running(placed.select("doc_id", "size", "text_crc32", "grp", "shard", "one"), order, ["one"], "shard-placed")
    first = groups.groupBy(number.alias("shard")).agg(F.sum("n").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranked.join(F.broadcast(first.select("shard", "before")), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("one_upto") - F.col("before") - 1).alias("slot"))
