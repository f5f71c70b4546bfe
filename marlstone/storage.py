"""Where intermediate tables live, and how tables are opened.

Everything that more than one executor has to see goes to the folder named by
``spark.checkpoint.dir``. A folder of our own is chosen only when that setting
is absent, which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, as a path Spark can write to."""
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_KEY} is not set; executors need a folder they all see")
        found = "file://" + tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set(_KEY, found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str, released: bool = False) -> str:
    """A path of its own in the shared folder; ``released``: ``release`` removes what is there."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if released:
        _MADE.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name, released=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table this package wrote."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Remove every table ``materialize`` wrote in this process, and what else is to be released; results not yet written are lost with them."""
    while _MADE:
        drop_path(spark, _MADE.pop())


#: A table in fewer files than there are cores is dealt to all of them if it has this many bytes, and no more than so many for each core.
DEAL_FROM, DEAL_UPTO = 4 << 20, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one in few files, which few tasks would read, is dealt to all cores by a shuffle of its bytes."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores, files = spark.sparkContext.defaultParallelism, rows.inputFiles()
    if len(files) >= cores:
        return rows
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(f)) for f in files]
    size = sum(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)
    return rows.repartition(cores) if DEAL_FROM <= size <= DEAL_UPTO * cores else rows
