"""Sums: overall, by day, by month, and the distinct keys.

All of these combine map-side, so a key with a third of the rows costs its
shuffle one row per group and task.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions.dates import month_label, month_start
from dayfold.functions.measures import active, guarded_ratio
from dayfold.operators.latest import Latest, last_row_per_key
from dayfold.schema import DEFAULT_SPEC, PanelSpec


def _sums(
    confirmed: Column, deaths: Column, recoveries: Column, total_active: Column | None
) -> Column:
    """Four totals as one value of an aggregate; zeros where there are no rows."""

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    by_difference = active(total(confirmed), total(recoveries))
    return F.struct(
        total(confirmed).alias("total_confirmed"),
        total(deaths).alias("total_deaths"),
        total(recoveries).alias("total_recoveries"),
        (by_difference if total_active is None else total(total_active)).alias("total_active"),
    )


def _with_rates(totals: DataFrame, *more: str) -> DataFrame:
    cases = F.col("total_confirmed")
    return totals.select(
        *more,
        "total_confirmed",
        "total_deaths",
        "total_recoveries",
        "total_active",
        guarded_ratio(F.col("total_recoveries"), cases).alias("recovery_rate"),
        guarded_ratio(F.col("total_active"), cases).alias("active_rate"),
    )


def global_summary(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Six totals over **all rows**, in one pass; zeros for an empty table."""
    sums = _sums(F.col(spec.confirmed), F.col(spec.deaths), F.col(spec.recoveries), None)
    return _with_rates(facts.agg(sums.alias("sums")).select("sums.*"))


def _sums_of_last(columns: Collection[str], spec: PanelSpec) -> Column:
    """The totals of last rows, by the columns that are there."""
    recoveries = F.col(spec.recoveries) if spec.recoveries in columns else F.lit(0)
    ready = spec.active in columns
    per_row = F.col(spec.active) if ready else active(F.col(spec.confirmed), recoveries)
    return _sums(F.col(spec.confirmed), F.col(spec.deaths), recoveries, per_row)


def global_summary_latest(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    """The same six totals over the **last row of each key** only.

    A table without recoveries counts them as 0, and an existing active column
    is preferred over the difference.
    """
    sums = _sums_of_last(facts.columns, spec)
    last = last_row_per_key(facts, spec, latest)
    return _with_rates(last.agg(sums.alias("sums")).select("sums.*"))


def summaries_latest(
    facts: DataFrame,
    variants: Mapping[str, Collection[str]],
    spec: PanelSpec = DEFAULT_SPEC,
    latest: Latest = None,
) -> DataFrame:
    """``global_summary_latest`` for each ``variant``, as if the facts had its columns
    alone. Last rows are found once, so the tiebreak must be the spec's."""
    if not spec.tiebreak:
        raise ValueError("variants need a tiebreak that does not depend on their columns")
    last = last_row_per_key(facts, spec, latest)
    sums = last.agg(*[_sums_of_last(c, spec).alias(name) for name, c in variants.items()])
    each = F.array(*[F.struct(F.lit(n).alias("variant"), F.col(n).alias("sums")) for n in variants])
    return _with_rates(sums.select(F.inline(each)).select("variant", "sums.*"), "variant")


def sum_by_day(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Daily totals in no particular order, for further steps."""
    return facts.groupBy(spec.date).agg(
        F.sum(spec.confirmed).alias("daily_confirmed"),
        F.sum(spec.deaths).alias("daily_deaths"),
        F.sum(spec.recoveries).alias("daily_recoveries"),
    )


def daily_totals(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    return sum_by_day(facts, spec).orderBy(spec.date)


def sum_by_month(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Monthly totals per key in no particular order.

    Rows are grouped by the month's first day; the text is made once per group.
    """
    start = month_start(F.col(spec.date)).alias("month_start")
    return (
        facts.groupBy(spec.key, start)
        .agg(F.sum(spec.confirmed).alias("monthly_confirmed"))
        .select(spec.key, month_label(F.col("month_start")).alias("month"), "monthly_confirmed")
    )


def monthly_totals(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    return sum_by_month(facts, spec).orderBy(spec.key, "month")


def key_list(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Distinct keys that have data, sorted."""
    keys = facts.select(spec.key).where(F.col(spec.key).isNotNull())
    return keys.distinct().orderBy(spec.key)
