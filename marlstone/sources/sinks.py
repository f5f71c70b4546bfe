"""Sinks: JSON lines, content-addressed files, text exports, rejects, indexes and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.storage import drop_path


def write_jsonl(df: DataFrame, path: str) -> None:
    """Rewrite the file set as a whole."""
    df.write.mode("overwrite").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append a run's records; a run appends once, after its work."""
    df.write.mode("append").json(path)


def content_addressed(files: DataFrame, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Files (content, sha256, ...) to (one new file for each hash, counts of new and duplicate ones)."""
    one = files.dropDuplicates(["sha256"])
    new = one if stored is None else one.join(stored.select("sha256"), "sha256", "left_anti")
    counts = files.agg(F.count("*").alias("fetched")).crossJoin(new.agg(F.count("*").alias("new"))).select("new", (F.col("fetched") - F.col("new")).alias("duplicates"))
    return new, counts


def export_texts(docs: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """What an export writes: file, text, and whether an earlier export of it differed (stale)."""
    rows = docs.select(F.concat(F.col("document_id").cast("string"), F.lit(".txt")).alias("file"), F.col("body").alias("text"))
    if before is None:
        return rows.withColumn("stale", F.lit(False))
    old = before.select(F.col("file").alias("f"), F.col("text").alias("old"))
    return rows.join(old, F.col("file") == F.col("f"), "left").select("file", "text", (F.col("f").isNotNull() & ~F.col("text").eqNullSafe(F.col("old"))).alias("stale"))


def write_texts(exported: DataFrame, path: str) -> None:
    """One folder for each file name with its text."""
    exported.select("file", "text").write.mode("overwrite").partitionBy("file").option("lineSep", "\x00").text(path)


def append_rejects(rejects: DataFrame, path: str) -> None:
    rejects.select("version", "problem").write.mode("append").json(path)


def write_indexed(df: DataFrame, name: str, keys: list[str], buckets: int = 16, mode: str = "overwrite") -> None:
    """A table bucketed and sorted by its lookup keys, with statistics: what stands in for an index."""
    spark = df.sparkSession
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(keys)}")


def table_sizes(spark: SparkSession, names: list[str]) -> DataFrame:
    """Rows and bytes of tables, from the catalog's statistics."""
    rows = []
    for n in names:
        spark.sql(f"ANALYZE TABLE {n} COMPUTE STATISTICS")
        stats = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {n}").collect()}["Statistics"]
        size, _, count = stats.partition(" bytes, ")
        rows.append((n, int(count.split()[0]), int(size)))
    return spark.createDataFrame(rows, "table string, n_rows long, bytes long")


def swap(df: DataFrame, path: str) -> None:
    """Replace a Parquet table that ``df`` may be derived from: write beside it, then rename."""
    spark = df.sparkSession
    beside = path.rstrip("/") + ".new"
    df.write.mode("overwrite").parquet(beside)
    jvm = spark.sparkContext._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(beside), jvm.org.apache.hadoop.fs.Path(path)
    drop_path(spark, path)
    if not new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(new, old):
        raise OSError(f"{beside} could not be renamed")
