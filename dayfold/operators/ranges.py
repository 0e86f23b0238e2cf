"""Running totals and changes over more rows than one task should sort.

Rows are sorted by range of date over many tasks, and each range is worked through on
its own; only one row for each range passes through a single task. For grids finer
than days; of rows with equal dates each stands for its own, in no particular order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.operators.cumulative import running
from dayfold.schema import DEFAULT_SPEC
from dayfold.sources.sinks import cut


def in_ranges(grid: DataFrame, date: str) -> DataFrame:
    """The rows with ``_range``, which rises with the date; those without one come
    first. Ranges are drawn from a sample, so the outcome is cut to stay what it is."""
    return cut(grid.repartitionByRange(F.asc_nulls_first(date)).withColumn(
        "_range", F.spark_partition_id()
    ))


def running_total_in_ranges(
    grid: DataFrame,
    value: str = "daily_confirmed",
    name: str = "cumulative_confirmed",
    date: str = DEFAULT_SPEC.date,
) -> DataFrame:
    """``running_total``, each range on top of the sum of those before."""
    ranged = in_ranges(grid, date)
    ranges_before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum(value).alias("_sum"))
        .select(
            F.col("_range").alias("_of"),
            F.coalesce(F.sum("_sum").over(ranges_before), F.lit(0)).alias("_before"),
        )
    )
    within = running(F.col(value), Window.partitionBy("_range").orderBy(date))
    return (
        ranged.withColumn("_within", within)
        .join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
        .select(*grid.columns, (F.col("_before") + F.col("_within")).alias(name))
        .orderBy(date)
    )


def delta_in_ranges(
    grid: DataFrame,
    value: str = "daily_confirmed",
    name: str = "delta_confirmed",
    date: str = DEFAULT_SPEC.date,
) -> DataFrame:
    """``daily_delta``: the first row of a range follows the last of the range before."""
    ranged = in_ranges(grid, date)
    place = F.struct(F.col(date).isNotNull(), F.col(date))
    last = F.max_by(F.struct(value), place)
    carried = (
        ranged.groupBy("_range")
        .agg(last.alias("_last"))
        .select(
            F.col("_range").alias("_of"),
            F.lag(f"_last.{value}").over(Window.orderBy("_range")).alias("_carried"),
        )
    )
    own = Window.partitionBy("_range").orderBy(date)
    previous = F.when(F.row_number().over(own) == 1, F.col("_carried")).otherwise(F.lag(value).over(own))
    return (
        ranged.join(F.broadcast(carried), F.col("_range") == F.col("_of"))
        .withColumn("_previous", previous)
        .select(*grid.columns, (F.col(value) - F.col("_previous")).alias(name))
        .orderBy(date)
    )
