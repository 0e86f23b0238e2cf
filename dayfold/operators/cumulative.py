"""Running totals and changes from row to row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions.dates import month_start
from dayfold.schema import DEFAULT_SPEC, PanelSpec


def running(value: Column, window) -> Column:
    """Running sum by rows. A NULL adds nothing and stays NULL itself."""
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(value.isNotNull(), F.sum(value).over(frame))


def running_total(
    daily: DataFrame,
    value: str = "daily_confirmed",
    name: str = "cumulative_confirmed",
    date: str = DEFAULT_SPEC.date,
) -> DataFrame:
    """Running total over one row per day, ordered by date.

    The window has one partition, and its size is the number of days, however
    many facts there are. For finer grids use ``running_total_two_pass``, or
    ``running_total_in_ranges`` where a month is too much for a task as well.
    """
    return daily.withColumn(name, running(F.col(value), Window.orderBy(date))).orderBy(date)


def running_total_two_pass(
    grid: DataFrame,
    value: str = "daily_confirmed",
    name: str = "cumulative_confirmed",
    date: str = DEFAULT_SPEC.date,
) -> DataFrame:
    """The same total with the grid spread over months.

    Only the monthly sums pass through one task; each month then runs its own
    total on top of the sum of the months before. Rows without a date come first,
    as in the plain form, and are a month of their own. Both passes read ``grid``,
    so settle it first when it is costly to compute.
    """
    by_month = grid.withColumn("_month", month_start(F.col(date)))
    months_before = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        by_month.groupBy("_month")
        .agg(F.sum(value).alias("_sum"))
        .select(
            F.col("_month").alias("_of"),
            F.coalesce(F.sum("_sum").over(months_before), F.lit(0)).alias("_before"),
        )
    )
    within = running(F.col(value), Window.partitionBy("_month").orderBy(date))
    return (
        by_month.withColumn("_within", within)
        .join(offsets, F.col("_month").eqNullSafe(F.col("_of")))
        .select(*grid.columns, (F.col("_before") + F.col("_within")).alias(name))
        .orderBy(date)
    )


def key_timelines(
    facts: DataFrame, key: str | None = None, spec: PanelSpec = DEFAULT_SPEC
) -> DataFrame:
    """Daily sums per key with their running total; for one key or for all.

    Summing to (key, day) first bounds a window partition by the number of days,
    also for a key that holds most of the facts. The daily rows are then spread
    by key range, which serves the window and the final order alike.
    """
    if key is not None:
        facts = facts.where(F.col(spec.key) == key)
    daily = (
        facts.groupBy(spec.key, spec.date)
        .agg(F.sum(spec.confirmed).alias("daily_confirmed"))
        .repartitionByRange(spec.key)
    )
    own_days = Window.partitionBy(spec.key).orderBy(spec.date)
    return daily.withColumn(
        "cumulative", running(F.col("daily_confirmed"), own_days)
    ).orderBy(spec.key, spec.date)


def monthly_growth(monthly: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Percent change on the key's previous month present.

    NULL for a key's first month and where the previous month is 0.
    """
    previous = F.lag("monthly_confirmed").over(Window.partitionBy(spec.key).orderBy("month"))
    change = F.col("monthly_confirmed") - F.col("previous_confirmed")
    return (
        monthly.withColumn("previous_confirmed", previous)
        .withColumn(
            "growth_pct",
            F.when(F.col("previous_confirmed") != 0, change * 100.0 / F.col("previous_confirmed")),
        )
        .orderBy(spec.key, "month")
    )


def daily_delta(daily: DataFrame, date: str = DEFAULT_SPEC.date) -> DataFrame:
    """Change of the daily total on the previous day present; NULL on the first."""
    previous = F.lag("daily_confirmed").over(Window.orderBy(date))
    return daily.select(
        date, "daily_confirmed", (F.col("daily_confirmed") - previous).alias("delta_confirmed")
    ).orderBy(date)
