"""Calendar and dense key-by-day panel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.dates import as_date, calendar_days
from dayfold.schema import DEFAULT_SPEC, PanelSpec

# Days a dimension row unfolds into before the panel is spread over tasks.
STRETCH = 16


def calendar(spark: SparkSession, days: int, as_of: date | str | Column) -> DataFrame:
    """``days`` consecutive dates ending at ``as_of``."""
    return spark.range(1).select(F.explode(calendar_days(days, as_of)).alias("Date"))


def dense_panel(
    dim: DataFrame, days: int, as_of: date | str | Column, spec: PanelSpec = DEFAULT_SPEC
) -> DataFrame:
    """Every key on every day, exactly once, with ``day_index`` from 0.

    Each dimension row unfolds into its own days, so nothing is joined. It does
    so in two steps, first into stretches of ``STRETCH`` days, which AQE spreads
    over as many tasks as their size calls for. Unfolding at once would leave a
    long calendar to the few tasks that read a small dimension.
    """
    if days < 0:
        raise ValueError("days must not be negative")
    first, last = F.col("_first"), F.lit(days - 1)
    starts = F.sequence(F.lit(0), last, F.lit(STRETCH)) if days else F.array().cast("array<int>")
    stretches = dim.select("*", F.explode(starts).alias("_first")).hint("rebalance")
    index = F.sequence(first, F.least(first + (STRETCH - 1), last))
    start = F.date_sub(as_date(as_of), days - 1)
    return (
        stretches.select("*", F.explode(index).alias("day_index"))
        .drop("_first")
        .withColumn(spec.date, F.date_add(start, F.col("day_index")))
    )
