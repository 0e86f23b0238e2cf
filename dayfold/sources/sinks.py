"""Writing the fact table, settling shared intermediates, bounded delivery."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.dates import month_start
from dayfold.schema import DEFAULT_SPEC, PanelSpec


def write_facts(
    facts: DataFrame,
    path: str,
    spec: PanelSpec = DEFAULT_SPEC,
    mode: str = "errorifexists",
    split_by: str | None = None,
) -> None:
    """Write facts clustered by key and month, sorted by key and date.

    Rows are spread by (key, month) rather than by key alone, and as a rebalance
    rather than a plain repartition: AQE then splits a (key, month) that is too
    large for one task and merges small ones. The sort inside each file gives
    row groups narrow key and date ranges, which pushed filters skip by.

    ``split_by`` divides the table into folders, by month, in a column named
    ``spec.month``, or by key. Rows are then spread by what folders are split by
    alone, so that a folder has few files.
    """
    if split_by not in (None, "key", "month"):
        raise ValueError(f"facts are split by key or month, not by {split_by}")
    month = spec.month or "_month"
    spread = facts.withColumn(month, month_start(F.col(spec.date)))
    by = {None: [spec.key, month], "key": [spec.key], "month": [month]}[split_by]
    spread = spread.hint("rebalance", *map(F.col, by))
    spread = spread.sortWithinPartitions(*([month] if split_by == "month" else []), spec.key, spec.date)
    if split_by != "month":
        spread = spread.drop(month)
    writer = spread.write.mode(mode)
    (writer.partitionBy(*by) if split_by else writer).parquet(path)


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """``folder``, or the checkpoint folder of the session or of its context. Only where
    there is none and all runs in one process is one of our own made."""
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that all executors share, or set spark.checkpoint.dir")
        folder = f"file://{tempfile.mkdtemp(prefix='dayfold-shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def settled(df: DataFrame, folder: str | None = None) -> Iterator[DataFrame]:
    """A reduced table written once, for the time of the context.

    For a table that several actions or branches read. The copy is columnar,
    carries statistics, and outlives a lost executor, which a cache does not. It
    lies in ``folder``, which all executors must reach, or in the session's
    checkpoint folder, and is removed at the end.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark, folder)}/dayfold/settled-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Compute a table and go on from a checkpoint of it in the shared folder, which
    Spark's cleaner may remove after use."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and the file system that it is on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, on whatever file system it is."""
    target, files = file_system(spark, path)
    files.delete(target, True)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def one_row(df: DataFrame) -> dict:
    """A one-row result, such as a summary, as a dict."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row, got {'more' if rows else 'none'}")
    return rows[0].asDict()


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
