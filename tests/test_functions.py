"""Scalar functions against Python's own arithmetic and formatting."""

import math
import random
from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from dayfold.functions.dates import calendar_days, month_label, month_start
from dayfold.functions.formats import fixed_decimals, human_number, thousands
from dayfold.functions.measures import (
    guarded_ratio,
    per_capita_rate,
    population_units,
    risk_label,
    truncate_at_zero,
)


def expected_human(x):
    units = ["", "K", "M", "B", "T"]
    step = 0
    while abs(x) >= 1000.0 and step < 4:
        x, step = x / 1000.0, step + 1
    return f"{x:.1f}{units[step]}"


NUMBERS = [
    0.0, 0.04, 0.05, 0.25, 0.35, 0.45, -0.25, -0.04, 1.0, 12.345, 999.0, 999.94, 999.95, 999.96,
    1000.0, 1250.0, -1250.0, 1350.0, 1e6, 1.25e6, 999_999.0, 999_950.0, 1e9, 2.55e9, 1e12,
    2.5e15, -7.25e12, 123_456_789.0,
]


def test_human_number(spark):
    rng = random.Random(5)
    values = NUMBERS + [rng.uniform(-1, 1) * 10 ** rng.randint(0, 15) for _ in range(3000)]
    values += [float(k * 50) for k in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", human_number(F.col("x"))).collect()
    assert [(x, text) for x, text in got if text != expected_human(x)] == []


def test_human_number_examples(spark):
    pairs = {
        0.0: "0.0", 0.25: "0.2", 0.35: "0.3", 999.96: "1000.0", 1250.0: "1.2K",
        -1250.0: "-1.2K", 1e12: "1.0T", 2.5e15: "2500.0T",
    }
    df = spark.createDataFrame([(k,) for k in pairs], "x double")
    assert dict(rows(df.select("x", human_number(F.col("x"))))) == pairs


def test_human_number_of_integers_and_null(spark):
    df = spark.createDataFrame([(1500,), (None,)], "x bigint")
    assert rows(df.select(human_number(F.col("x")))) == [("1.5K",), (None,)]


@pytest.mark.parametrize("places", [1, 2])
def test_fixed_decimals(spark, places):
    rng = random.Random(6)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(0, 9) for _ in range(3000)] + NUMBERS[:20]
    values += [k / 8 for k in range(-400, 400)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", fixed_decimals(F.col("x"), places)).collect()
    assert [(x, t) for x, t in got if t != f"{x:.{places}f}"] == []


def test_thousands_truncates(spark):
    values = [0.0, 999.9, -999.9, 1000.0, 1234567.9, -1234567.9, 98765432101.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [t for (t,) in rows(df.select(thousands(F.col("x"))))] == [f"{int(v):,}" for v in values]


def test_guarded_ratio_never_raises(spark):
    df = spark.createDataFrame([(3, 4), (3, 0), (0, 0), (3, None)], "n bigint, d bigint")
    got = rows(df.select(guarded_ratio(F.col("n"), F.col("d"))))
    assert got == [(0.75,), (0.0,), (0.0,), (0.0,)]


def test_population_floor(spark):
    populations = [0, 1, 99_999, 100_000, 100_001, 250_000, None]
    df = spark.createDataFrame([(p,) for p in populations], "p bigint")
    got = [u for (u,) in rows(df.select(population_units(F.col("p"))))]
    assert got == [None if p is None else max(1, p / 100_000) for p in populations]


def test_per_capita_rate(spark):
    df = spark.createDataFrame([(50, 20, 99_999), (50, 20, 400_000)], "c int, r int, p bigint")
    got = rows(df.select(per_capita_rate(F.col("c"), F.col("r"), F.col("p"))))
    assert got == [(30.0,), (7.5,)]


def test_risk_bounds_are_strict(spark):
    cases = [
        (0.0, "LOW"), (0.05, "LOW"), (math.nextafter(0.05, 1), "MEDIUM"), (0.12, "MEDIUM"),
        (math.nextafter(0.12, 1), "HIGH"), (1.0, "HIGH"), (-0.5, "LOW"), (None, "LOW"),
    ]
    df = spark.createDataFrame([(r,) for r, _ in cases], "r double")
    assert [t for (t,) in rows(df.select(risk_label(F.col("r"))))] == [t for _, t in cases]


def test_truncate_at_zero(spark):
    df = spark.createDataFrame([(v,) for v in (2.9, -0.9, -3.0, 0.0, 7.0)], "x double")
    assert [v for (v,) in rows(df.select(truncate_at_zero(F.col("x"))))] == [2, 0, 0, 0, 7]


def test_dates(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),), (date(1999, 12, 31),)], "d date")
    assert rows(df.select(month_label(F.col("d")), month_start(F.col("d")))) == [
        ("2024-02", date(2024, 2, 1)), ("1999-12", date(1999, 12, 1)),
    ]


@pytest.mark.parametrize("days,first", [(1, date(2024, 3, 1)), (3, date(2024, 2, 28))])
def test_calendar_days(spark, days, first):
    got = spark.range(1).select(calendar_days(days, date(2024, 3, 1))).collect()[0][0]
    assert len(got) == days and got[0] == first and got[-1] == date(2024, 3, 1)


def test_calendar_days_limits(spark):
    assert spark.range(1).select(calendar_days(0, "2024-03-01")).collect()[0][0] == []
    with pytest.raises(ValueError):
        calendar_days(-1, "2024-03-01")
