"""Record sources: JSON lines, folders of JSON files, text and binary files, versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines. A missing path is empty; a malformed line fails (strict) or is left out."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def read_jsonl_counted(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the malformed lines as text."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("_ok", F.try_parse_json("value").isNotNull())
    rows = lines.where("_ok").select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows, lines.where("not _ok").select(F.col("value").alias("line"))


def with_sequence(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A log with ``seq``, the order its records were appended in: by file and place, or by the given columns."""
    if by:
        from marlstone.operators.ranking import with_rank

        return with_rank(records, [F.col(c) for c in by], "seq")
    return records.withColumn("seq", F.monotonically_increasing_id())


def read_json_folder(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per file: file, valid, data (variant), n_records; a single object counts as a list of one."""
    text = spark.read.text(pattern, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value")
    data = F.try_parse_json("value")
    rows = text.select("file", F.col("value").isNotNull().alias("_r"), data.alias("data"))
    many = F.schema_of_variant("data").startswith("ARRAY")
    return rows.select("file", F.col("data").isNotNull().alias("valid"), "data", F.when(many, F.size(F.try_variant_get("data", "$", "array<variant>"))).when(F.col("data").isNotNull(), 1).cast("long").alias("n_records"))


def records_of(files: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of valid files with file and place, fields by ``schema``; unreadable fields are null."""
    many = F.schema_of_variant("data").startswith("ARRAY")
    items = F.when(many, F.try_variant_get("data", "$", "array<variant>")).otherwise(F.array("data"))
    rows = files.where("valid").select("file", F.posexplode(items).alias("place", "rec"))
    return rows.select("file", "place", "rec", *[F.try_variant_get("rec", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema])


def last_file_wins(records: DataFrame, key: str = "document_id") -> DataFrame:
    """One record per key: that of the last file, at its last place."""
    order = Window.partitionBy(key).orderBy(F.desc("file"), F.desc("place"))
    return records.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def read_texts(spark: SparkSession, pattern: str) -> DataFrame:
    """path and text of whole text files."""
    return spark.read.text(pattern, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_landing(spark: SparkSession, pattern: str) -> DataFrame:
    """Files of a landing folder: path, content, bytes, sha256 and whether they are PDFs."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", "content", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), (F.substring("content", 1, 5) == F.lit(b"%PDF-")).alias("is_pdf"))


def of_version(policies: DataFrame, version: str) -> DataFrame:
    """Scores of one codebook version; a table partitioned by it is pruned."""
    return policies.where(F.col("prompt_version") == version)
