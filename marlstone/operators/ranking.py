"""Global ranks without a single-task window: ranks within ranges plus the rows of the ranges before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.storage import materialize


def with_rank(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``rows`` with ``name``, 1 for the first by ``order``; the order of ties is any."""
    dealt = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    bases = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_in", within).join(F.broadcast(bases), "_range").select(*rows.columns, (F.col("_base") + F.col("_in")).cast("long").alias(name))
