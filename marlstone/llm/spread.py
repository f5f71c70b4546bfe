"""Joins of many rows with one row for each key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.storage import materialize

#: A key with more than 1 / HOT of all rows is hot; there are fewer than HOT of those.
HOT = 2000


def join_spread(many: DataFrame, one: DataFrame, keys: list[str], count: str, total: int | None = None) -> DataFrame:
    """The inner join of ``many`` with ``one``, which has a row for each key and its number of rows of ``many``.

    Hot keys, fewer than HOT rows of ``one``, are broadcast, and the rows of ``many`` that have
    them are not shuffled. The rest is joined by shuffling; no key there has many rows. Null
    keys find nothing. ``one`` should be a table or cheap: it is read three times. Its ``count`` is not
    in the result. ``total`` is the sum of ``count``, if it is known.
    """
    if total is None:
        total = one.agg(F.sum(count).alias("n")).first()["n"] or 0
    is_hot = F.col(count) * F.lit(HOT) > F.lit(int(total))
    hot, cold = one.where(is_hot).drop(count), one.where(~is_hot).drop(count)
    few = F.broadcast(hot)
    return many.join(few, keys).unionByName(many.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys))


def join_salted(many: DataFrame, one: DataFrame, key: str, least: int = 1000) -> DataFrame:
    """The inner join of ``many`` with ``one``, which has a row for each key, possibly a large one.

    A key with more rows of ``many`` than ``least`` and than 1 / HOT of all is cut into cells;
    its row of ``one`` goes to each, so that rows of ``one`` are copied HOT times at most.
    """
    counts = materialize(many.groupBy(key).agg(F.count("*").alias("_n")), "salted-counts")
    total = counts.agg(F.sum("_n").alias("n")).first()["n"] or 0
    cells = counts.withColumn("_cells", F.ceil(F.col("_n") / F.lit(max(least, int(total) // HOT))).cast("int"))
    dealt = join_spread(many, cells, [key], "_n", int(total)).withColumn("_cell", F.expr(f"cast(pmod(xxhash64({', '.join(f'`{c}`' for c in many.columns)}), _cells) as int)")).drop("_cells")
    copied = one.join(cells.select(key, "_cells"), key).withColumn("_cell", F.explode(F.expr("sequence(0, _cells - 1)"))).drop("_cells")
    return dealt.join(copied, [key, "_cell"]).drop("_cell")
