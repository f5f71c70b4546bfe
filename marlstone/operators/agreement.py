"""Agreement between two coders of the same documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.text import pct


def paired(first: DataFrame, second: DataFrame, key: str = "document_id") -> DataFrame:
    """Documents both coded: key, scale, a, b from two long tables (key, scale, score)."""
    return first.select(key, "scale", F.col("score").alias("a")).join(second.select(key, "scale", F.col("score").alias("b")), [key, "scale"])


def rates(pairs: DataFrame) -> DataFrame:
    """Per scale: n, exact, within_1, disagreements and the shares."""
    exact, near = F.count_if(F.col("a") == F.col("b")), F.count_if(F.abs(F.col("a") - F.col("b")) <= 1)
    rows = pairs.groupBy("scale").agg(F.count("*").alias("n"), exact.alias("exact"), near.alias("within_1"))
    return rows.select("*", (F.col("n") - F.col("exact")).alias("disagreements"), pct(F.col("exact"), F.col("n")).alias("exact_pct"), pct(F.col("within_1"), F.col("n")).alias("within_1_pct"))


def nominal(pairs: DataFrame, by: str = "field") -> DataFrame:
    """Per field: share of equal values; two nulls are equal, a null and a value are not."""
    rows = pairs.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same"))
    return rows.select("*", pct(F.col("same"), F.col("n")).alias("same_pct"))


def wide(pairs: DataFrame, least: int = 2) -> DataFrame:
    """Pairs at least ``least`` bins apart."""
    return pairs.where(F.abs(F.col("a") - F.col("b")) >= least)


def alpha_ordinal(pairs: DataFrame, by: str = "scale") -> DataFrame:
    """Krippendorff's alpha with the ordinal difference, per group: n_units, alpha.

    Only coincidence counts (values x values) remain after the first aggregation; the distance
    of two values is a difference of running totals of the values' counts.
    """
    seen = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(F.col(by).alias("g"), "a", "b")
    both = seen.select("g", F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("b").alias("k")), F.struct(F.col("b").alias("c"), F.col("a").alias("k")))).alias("p"))
    o = both.groupBy("g", "p.c", "p.k").agg(F.count("*").alias("o"))
    v = o.groupBy("g", F.col("c").alias("v")).agg(F.sum("o").alias("n_v"))
    run = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    v = v.withColumn("upto", F.sum("n_v").over(run)).withColumn("n", F.sum("n_v").over(Window.partitionBy("g"))).withColumn("values", F.count("*").over(Window.partitionBy("g")))
    x, y = (v.select("g", *[F.col(c).alias(f"{s}_{c}") for c in ("v", "n_v", "upto", "n", "values")]) for s in ("x", "y"))
    grid = x.join(y, "g").join(o.select("g", F.col("c").alias("x_v"), F.col("k").alias("y_v"), "o"), ["g", "x_v", "y_v"], "left")
    low_first = F.col("x_v") <= F.col("y_v")
    span = F.when(low_first, F.col("y_upto") - F.col("x_upto") + F.col("x_n_v")).otherwise(F.col("x_upto") - F.col("y_upto") + F.col("y_n_v"))
    gap = span - (F.col("x_n_v") + F.col("y_n_v")) / F.lit(2.0)
    grid = grid.withColumn("d", gap * gap)
    sums = grid.groupBy("g").agg(
        F.sum(F.coalesce("o", F.lit(0)) * F.col("d")).alias("seen"),
        F.sum(F.col("x_n_v") * F.col("y_n_v") * F.col("d")).alias("chance"),
        F.max("x_n").cast("double").alias("n"),
        F.max("x_values").alias("values"),
    )
    observed, expected = F.col("seen") / F.col("n"), F.col("chance") / (F.col("n") * (F.col("n") - 1))
    alpha = F.when((F.col("values") < 2) | (F.col("chance") == 0), F.lit(1.0)).otherwise(1.0 - observed / expected)
    return sums.select(F.col("g").alias(by), (F.col("n") / 2).cast("long").alias("n_units"), alpha.alias("alpha"))


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per scale between two versions: n, changed, moved by two or more, strict shares before and after."""
    pairs = paired(before, after)
    rows = pairs.groupBy("scale").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("a") != F.col("b")).alias("changed"),
        F.count_if(F.abs(F.col("a") - F.col("b")) >= 2).alias("moved_2"),
        F.count_if(F.col("a") >= 4).alias("strict_before"),
        F.count_if(F.col("a") > 0).alias("addressed_before"),
        F.count_if(F.col("b") >= 4).alias("strict_after"),
        F.count_if(F.col("b") > 0).alias("addressed_after"),
    )
    return rows.select("*", pct(F.col("changed"), F.col("n")).alias("changed_pct"), pct(F.col("strict_before"), F.col("addressed_before")).alias("strict_before_pct"), pct(F.col("strict_after"), F.col("addressed_after")).alias("strict_after_pct"))
