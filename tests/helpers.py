"""Small fact tables and plain-Python expectations."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import types as T

from dayfold.schema import FACT_SCHEMA

# As the fact schema, with every column nullable and an id to break ties by.
LOOSE_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in FACT_SCHEMA.fields]
    + [T.StructField("id", T.LongType(), True)]
)

PLACES = {"A": ("AAA", 1.0, 2.0), "B": ("BBB", -3.5, 4.25), "C": ("CCC", 0.0, 0.0)}


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def fact(key, n, confirmed, deaths=0, recoveries=0, rate=0.0, id=0, place=None):
    iso, lat, lon = place or PLACES.get(key, ("ZZZ", 9.0, 9.0))
    when = None if n is None else day(n)
    return (when, key, iso, lat, lon, confirmed, deaths, recoveries, rate, id)


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), LOOSE_SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    """The plan as explain() prints it, before execution."""
    return df._jdf.queryExecution().executedPlan().toString()
