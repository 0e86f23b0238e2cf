"""The fact table as it is stored: written once for what its sources hold, split into
folders, and asked for counts and bounds without reading a row."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.schema import FACT_SCHEMA, PanelSpec
from dayfold.sources.shipments import TABLES, Shipments
from dayfold.sources.sinks import file_system, shared_folder, write_facts

STORED_SPEC = PanelSpec(month="month")


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Changes with any file under ``paths``: its name, size or time. Files are listed,
    not opened."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    seen = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{sorted(paths)} {tuple(seen)}".encode()).hexdigest()[:24]


def complete(spark: SparkSession, path: str) -> bool:
    target, files = file_system(spark, f"{path}/_SUCCESS")
    return files.exists(target)


def stored_facts(ship: Shipments, split_by: str, folder: str | None = None) -> str:
    """Where the facts of a directory are stored, split by key or month. They are written
    if what the directory holds now has not been before; a broken write is begun again.

    The folder is ``folder`` or the session's shared one, whose owner clears it.
    """
    spark = ship.spark
    of = fingerprint(spark, [f"{ship.sf_dir}/{name}.parquet" for name in sorted(TABLES)])
    path = f"{shared_folder(spark, folder)}/dayfold/facts-by-{split_by}-{of}"
    if not complete(spark, path):
        known = ship.facts.select(*FACT_SCHEMA.names).where("Country IS NOT NULL")
        write_facts(known, path, STORED_SPEC, "overwrite", split_by)
    return path


def footers(spark: SparkSession, path: str) -> DataFrame:
    """The table by a reader that answers counts and bounds, of all rows or by the
    columns that folders are split by, from file footers. It has a session of its own,
    as options decide which reader is used."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # Else the reader knows the folders' columns in small letters only.
    session.conf.set("spark.sql.caseSensitive", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session.read.schema(FACT_SCHEMA).parquet(path)


def _extent(spec: PanelSpec) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("fact_rows"),
        F.min(spec.date).alias("first_date"),
        F.max(spec.date).alias("latest_date"),
    ]


def footer_extent(spark: SparkSession, path: str, spec: PanelSpec) -> DataFrame:
    """Rows, first and last date of each key, for a table split by key."""
    return footers(spark, path).groupBy(spec.key).agg(*_extent(spec))


def footer_total(spark: SparkSession, path: str, spec: PanelSpec) -> DataFrame:
    """The same of the whole table, and whether it is empty."""
    return footers(spark, path).agg(*_extent(spec)).withColumn("is_empty", F.col("fact_rows") == 0)
