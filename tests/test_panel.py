"""Dimension, calendar and dense panel."""

from datetime import date

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from dayfold.operators.panel import calendar, dense_panel
from dayfold.schema import DIMENSION_SCHEMA
from dayfold.sources.countries import country_dimension, country_entries
from dayfold.sources.tables import dedup_dimension, denormalise, first_n_keys, keep_keys

AS_OF = date(2024, 3, 10)


def dim(spark, *entries):
    full = [(i, name, name[:3], lat, 0.0, people) for i, name, lat, people in entries]
    return spark.createDataFrame(full, DIMENSION_SCHEMA)


def test_dedup_keeps_last_value_at_first_position(spark):
    d = dim(spark, (0, "X", 1.0, 1), (1, "Y", 2.0, 2), (2, "X", 3.0, 3), (5, "X", 4.0, 9))
    got = rows(dedup_dimension(d).select(*d.columns).orderBy("ordinal"))
    assert got == [(0, "X", "X", 4.0, 0.0, 9), (1, "Y", "Y", 2.0, 0.0, 2)]


def test_dedup_aggregates_positions_by_hash(spark):
    d = dim(spark, (0, "X", 1.0, 1), (3, "Y", 2.0, 2), (4, "Y", 5.0, 7))
    got = dedup_dimension(d)
    assert "SortAggregate" not in plan(got) and "HashAggregate" in plan(got)
    assert sorted(rows(got.select("ordinal", "Latitude"))) == [(0, 1.0), (3, 5.0)]


def test_countries(spark):
    assert country_entries(spark).count() == 85
    d = country_dimension(spark).orderBy("ordinal").collect()
    assert len(d) == 84
    assert [r.Country for r in d[:3]] == ["India", "China", "United States"]
    assert d[0].Population == 1417173173 and d[0].ISO_Alpha == "IND"
    assert [r.ordinal for r in d if r.Country == "Senegal"] == [49]


@pytest.mark.parametrize("n,size", [(0, 0), (1, 1), (10, 10), (84, 84), (500, 84), (None, 84)])
def test_first_n(spark, n, size):
    kept = rows(first_n_keys(country_dimension(spark), n).select("Country"))
    assert len(kept) == size
    if n == 10:
        assert {k for (k,) in kept} == {
            "India", "China", "United States", "Indonesia", "Pakistan", "Brazil", "Nigeria",
            "Bangladesh", "Russia", "Mexico",
        }


def test_first_n_rejects_negative(spark):
    with pytest.raises(ValueError):
        first_n_keys(country_dimension(spark), -1)


def test_keep_keys_adds_no_copies(spark):
    f = spark.createDataFrame([("X", 1), ("X", 1), ("Z", 2), (None, 3)], "Country string, v int")
    d = dim(spark, (0, "X", 1.0, 1), (1, "X", 1.0, 1))
    assert rows(keep_keys(f, d)) == [("X", 1), ("X", 1)]


def test_denormalise(spark):
    f = spark.createDataFrame([("X", 1), ("X", 2)], "Country string, v int")
    got = denormalise(f, dim(spark, (0, "X", 1.5, 7)))
    assert got.columns == ["Country", "v", "ISO_Alpha", "Latitude", "Longitude", "Population"]
    assert sorted(rows(got)) == [("X", 1, "X", 1.5, 0.0, 7), ("X", 2, "X", 1.5, 0.0, 7)]


def test_calendar(spark):
    got = [d for (d,) in rows(calendar(spark, 5, AS_OF))]
    assert got == [date(2024, 3, n) for n in (6, 7, 8, 9, 10)]
    assert rows(calendar(spark, 0, AS_OF)) == []


def test_dense_panel_has_every_key_on_every_day_once(spark):
    d = country_dimension(spark)
    p = dense_panel(d, 30, AS_OF)
    assert p.count() == 84 * 30
    assert p.select("Country", "Date").distinct().count() == 84 * 30
    assert rows(p.agg(F.min("Date"), F.max("Date"), F.min("day_index"), F.max("day_index"))) == [
        (date(2024, 2, 10), AS_OF, 0, 29)
    ]


def test_dense_panel_takes_a_column_as_end(spark):
    end = calendar(spark, 3, AS_OF).agg(F.max("Date")).scalar()
    assert dense_panel(country_dimension(spark), 2, end).agg(F.max("Date")).collect()[0][0] == AS_OF
