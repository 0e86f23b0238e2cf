"""Column names and declared types of the fact and dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FACT_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType(), False),
        T.StructField("Country", T.StringType(), False),
        T.StructField("ISO_Alpha", T.StringType(), False),
        T.StructField("Latitude", T.DoubleType(), False),
        T.StructField("Longitude", T.DoubleType(), False),
        T.StructField("Confirmed", T.IntegerType(), False),
        T.StructField("Deaths", T.IntegerType(), False),
        T.StructField("Recoveries", T.IntegerType(), False),
        T.StructField("Active_Per_100k", T.DoubleType(), False),
    ]
)

# ``ordinal`` is the declared position of a row. A table has no order of its
# own, and both "the last duplicate wins" and "the first n keys" need one.
DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("Country", T.StringType(), False),
        T.StructField("ISO_Alpha", T.StringType(), False),
        T.StructField("Latitude", T.DoubleType(), False),
        T.StructField("Longitude", T.DoubleType(), False),
        T.StructField("Population", T.LongType(), False),
    ]
)


@dataclass(frozen=True)
class PanelSpec:
    """Which columns play which part; every operator takes one.

    ``tiebreak`` columns, together with key and date, identify a row. Without
    them the remaining columns of the table are used, in their order.
    ``scan_date`` names the stored column that the date is cast from, where that is
    another one; bounds on the date are put on it too, as only those reach a scan.
    ``month`` names the column of a stored table that its folders are split by, the
    first day of the date's month; months are chosen by it before a file is opened.
    """

    key: str = "Country"
    date: str = "Date"
    dim_attrs: tuple[str, ...] = ("ISO_Alpha", "Latitude", "Longitude")
    confirmed: str = "Confirmed"
    deaths: str = "Deaths"
    recoveries: str = "Recoveries"
    active: str = "Active"
    rate: str = "Active_Per_100k"
    population: str = "Population"
    ordinal: str = "ordinal"
    tiebreak: tuple[str, ...] = ()
    scan_date: str | None = None
    month: str | None = None

    @property
    def place(self) -> tuple[str, ...]:
        """Key and its denormalised attributes: one snapshot row per value."""
        return (self.key, *self.dim_attrs)


DEFAULT_SPEC = PanelSpec()
