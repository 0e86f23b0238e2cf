"""Numbers as text.

All of these go through ``format_number``, which rounds half-even on the exact
binary value. ``format_string("%.1f")`` rounds half-up on the shortest decimal
and gives 1.3K for 1250, where 1.2K is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One unit per division by 1000; beyond the last comes OVERFLOW.
UNITS = ("", "K", "M", "B")
OVERFLOW = "T"


def fixed_decimals(value: Column, places: int) -> Column:
    """Exactly ``places`` decimals and no thousands separators."""
    return F.replace(F.format_number(value.cast("double"), places), F.lit(","), F.lit(""))


def thousands(value: Column) -> Column:
    """Truncated toward zero, with separators: 1234567.9 becomes 1,234,567."""
    return F.format_number(value.cast("bigint"), 0)


def human_number(value: Column) -> Column:
    """One decimal and a unit: 1250 becomes 1.2K.

    The unit is chosen before rounding, so 999.96 is 1000.0 and not 1.0K.
    """
    scaled = value.cast("double")
    steps = []
    for unit in UNITS:
        steps.append((F.abs(scaled) < 1000.0, F.concat(fixed_decimals(scaled, 1), F.lit(unit))))
        scaled = scaled / F.lit(1000.0)
    (condition, text), *rest = steps
    chain = F.when(condition, text)
    for condition, text in rest:
        chain = chain.when(condition, text)
    return chain.otherwise(F.concat(fixed_decimals(scaled, 1), F.lit(OVERFLOW)))
