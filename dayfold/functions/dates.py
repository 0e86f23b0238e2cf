"""Date expressions: month buckets and calendar bounds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_FORMAT = "yyyy-MM"


def as_date(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, MONTH_FORMAT)


def calendar_days(days: int, as_of: date | str | Column) -> Column:
    """Array of the ``days`` dates that end at ``as_of``, both ends included."""
    if days < 0:
        raise ValueError("days must not be negative")
    if days == 0:
        return F.array().cast("array<date>")
    end = as_date(as_of)
    return F.sequence(F.date_sub(end, days - 1), end)
