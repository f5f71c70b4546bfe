"""Incremental ingest of append logs: a file stream that processes what is new and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources.records import exists


def ingest_new(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str) -> int:
    """Append to ``target`` the records of new files whose key it doesn't hold; returns how many batches ran.

    Within a batch the record that comes first in its file wins. A run that stopped half-way is
    taken up again; a batch that ran twice adds nothing, as its keys are there.
    """

    def load(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c != key]
        first = batch.withColumn("_at", F.monotonically_increasing_id()).groupBy(key).agg(F.min_by(F.struct(*rest), "_at").alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
        if exists(spark, target):
            first = first.join(spark.read.parquet(target).select(key), key, "left_anti")
        first.write.mode("append").parquet(target)

    query = spark.readStream.schema(schema).json(source).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)
