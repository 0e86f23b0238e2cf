"""Reading the fact table and preparing the dimension."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.schema import DEFAULT_SPEC, DIMENSION_SCHEMA, FACT_SCHEMA, PanelSpec


# Columns a fact table may come without, and one it may bring.
OPTIONAL_FACTS = ("Recoveries", "Active_Per_100k")
READY_ACTIVE = T.StructField("Active", T.IntegerType(), True)


def read_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    optional: Collection[str] = (),
) -> DataFrame:
    """Parquet with declared types.

    A declared column that the file lacks would be read as NULL. A required one is
    an error instead, and an optional one is left out of the table. A column of
    another type fails when it is read.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    stored = spark.read.parquet(path)
    types = {f.name: f.dataType for f in stored.schema}
    missing = [f.name for f in fields if f.name not in types]
    required = [name for name in missing if name not in optional]
    if required:
        raise ValueError(f"{path} has no column {', '.join(required)}")
    kept = T.StructType([f for f in fields if f.name not in missing])
    if all(types[f.name] == f.dataType for f in kept):
        return stored.select(*kept.names)
    return spark.read.schema(kept).parquet(path)


def read_facts(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """The fact table; without recoveries or rate where the file has none, and with
    a ready active column where it has one. ``month`` names the column that its folders
    are split by, if they are."""
    fields = [*FACT_SCHEMA.fields, READY_ACTIVE]
    if month:
        fields.append(T.StructField(month, T.DateType(), True))
    return read_typed(spark, path, T.StructType(fields), (*OPTIONAL_FACTS, READY_ACTIVE.name))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, DIMENSION_SCHEMA)


def facts_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """A fact table from Python rows; for small fixtures."""
    return spark.createDataFrame(list(rows), FACT_SCHEMA)


def dedup_dimension(dim: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per key: the values declared last, at the position declared first.

    Positions alone are aggregated, by hash and map-side, so a key with very many
    copies sends one row per task; the row declared last is then looked up by its
    position.
    """
    rest = [c for c in dim.columns if c not in (spec.key, spec.ordinal)]
    bounds = dim.groupBy(F.col(spec.key).alias("_key")).agg(
        F.min(spec.ordinal).alias("_first"), F.max(spec.ordinal).alias("_last")
    )
    declared_last = F.col(spec.key).eqNullSafe(F.col("_key")) & (
        F.col(spec.ordinal) == F.col("_last")
    )
    return dim.join(bounds, declared_last).select(
        F.col("_first").alias(spec.ordinal), spec.key, *rest
    )


def first_n_keys(dim: DataFrame, n: int | None, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The first ``n`` rows in declared order; ``None`` or a large n keeps all."""
    if n is None:
        return dim
    if n < 0:
        raise ValueError("n must not be negative")
    return dim.orderBy(spec.ordinal).limit(n)


def keep_keys(facts: DataFrame, dim: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Facts whose key is in the dimension; each at most once."""
    return facts.join(dim.select(spec.key), spec.key, "left_semi")


def denormalise(facts: DataFrame, dim: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Repeat the dimension's attributes on each fact row.

    No broadcast hint: Spark broadcasts a dimension it measures as small and
    joins by shuffle beyond that, where AQE splits a hot key.
    """
    attrs = [c for c in dim.columns if c not in facts.columns and c != spec.ordinal]
    return facts.join(dim.select(spec.key, *attrs), spec.key)
