"""Column expressions on measures: differences, ratios, rates and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rate is per this many people, and a population below it
# counts as exactly one unit.
PER_PEOPLE = 100_000.0

# An active rate strictly above the bound earns the label.
HIGH_ABOVE = 0.12
MEDIUM_ABOVE = 0.05


def active(confirmed: Column, recoveries: Column) -> Column:
    return confirmed - recoveries


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, and 0.0 where that is zero or NULL.

    The division sits inside the branch, so ANSI mode never sees a zero.
    """
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def population_units(population: Column) -> Column:
    """Population in units of 100,000, at least 1. NULL stays NULL."""
    return F.when(
        population.isNotNull(), F.greatest(F.lit(1.0), population / F.lit(PER_PEOPLE))
    )


def per_capita_rate(confirmed: Column, recoveries: Column, population: Column) -> Column:
    return active(confirmed, recoveries) / population_units(population)


def risk_label(active_rate: Column) -> Column:
    """HIGH, MEDIUM or LOW; a missing rate counts as 0."""
    rate = F.coalesce(active_rate, F.lit(0.0))
    return (
        F.when(rate > HIGH_ABOVE, "HIGH").when(rate > MEDIUM_ABOVE, "MEDIUM").otherwise("LOW")
    )


def truncate_at_zero(value: Column, to: str = "int") -> Column:
    """Drop the fraction (toward zero) and replace negatives by 0."""
    return F.greatest(F.lit(0).cast(to), value.cast(to))
