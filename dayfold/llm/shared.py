"""What the operators share: the folder all executors reach, and sizes of work."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Rows, of some hundred bytes at most, that are sent to every task.
BROADCAST_ROWS = 200_000

# Text in one block of documents; a Python task holds one block at a time.
BLOCK_BYTES = 6 << 20


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only where the session names none, as in a
    local test, one of our own is made and set for the rest of the session."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='dayfold-shared-')}"
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def copies_folder(spark: SparkSession) -> str:
    """Where this application's copies of tables lie."""
    return f"{shared_folder(spark)}/dayfold-llm/{spark.sparkContext.applicationId}"


def clear_copies(spark: SparkSession) -> None:
    """Remove all copies of this application. Results that have not been written or
    collected yet can't be read after it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(copies_folder(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


def settled(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and go on from the copy.

    Cuts the lineage, survives lost executors, and spares readers the work
    before it. A lazy result may still read the copy, so it stays until
    ``clear_copies`` or the folder's owner removes it.
    """
    path = f"{copies_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table that loops or several readers go on from, by
    a checkpoint in the shared folder, which Spark's cleaner may remove after use."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def counted(df: DataFrame) -> DataFrame:
    """A table of short rows that texts are matched with: cut, counted, and marked for
    broadcast if it has few rows. Beyond that the texts are shuffled to it."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def block_count(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks the documents make at ``block_bytes`` of text each, and no
    fewer than the session's shuffle partitions."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, math.ceil(total / block_bytes))


def spread(key: Column, n: int) -> Column:
    """A block number from 0 to ``n`` - 1 that depends on the key alone."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
