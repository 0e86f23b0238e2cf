"""Operators on hand-made tables: ties, NULLs, zeros, gaps, empty input."""

from datetime import date

import pytest
from helpers import LOOSE_SCHEMA, PLACES, day, fact, facts, rows
from pyspark.sql import functions as F

from dayfold.operators.cumulative import (
    daily_delta,
    key_timelines,
    monthly_growth,
    running_total,
    running_total_two_pass,
)
from dayfold.operators.latest import last_row_per_key, latest_date_by_key, latest_rows
from dayfold.operators.ranking import lookup, top_k
from dayfold.operators.snapshot import (
    daily_rollup,
    region_snapshot,
    region_snapshot_one_row,
    snapshot_from_rollup,
    snapshot_rows,
)
from dayfold.operators.totals import (
    daily_totals,
    global_summary,
    global_summary_latest,
    key_list,
    monthly_totals,
    summaries_latest,
)
from dayfold.schema import PanelSpec

SPEC = PanelSpec(tiebreak=("id",))
ZEROS = (0, 0, 0, 0, 0.0, 0.0)


@pytest.fixture
def tied(spark):
    """A: two rows on its latest date. B: an earlier latest date. C: one row."""
    return facts(
        spark,
        fact("A", 0, 10, 1, 4, 1.0, id=1),
        fact("A", 5, 20, 2, 8, 2.0, id=2),
        fact("A", 5, 7, 3, 1, 4.0, id=3),
        fact("B", 2, 100, 0, 50, 9.0, id=4),
        fact("B", 3, 30, 1, 30, 0.0, id=5),
        fact("C", 5, 27, 0, 0, 3.0, id=6),
    )


def test_summary_over_all_rows(tied):
    assert rows(global_summary(tied)) == [(194, 7, 93, 101, 93 / 194, 101 / 194)]


def test_summary_over_last_rows(tied):
    assert rows(global_summary_latest(tied, SPEC)) == [(64, 4, 31, 33, 31 / 64, 33 / 64)]


@pytest.mark.parametrize("summary", [global_summary, lambda df: global_summary_latest(df, SPEC)])
def test_summary_of_nothing_is_zero(spark, summary):
    assert rows(summary(spark.createDataFrame([], LOOSE_SCHEMA))) == [ZEROS]


@pytest.mark.parametrize("summary", [global_summary, lambda df: global_summary_latest(df, SPEC)])
def test_summary_of_zero_cases(spark, summary):
    assert rows(summary(facts(spark, fact("A", 0, 0), fact("B", 0, 0)))) == [ZEROS]


def test_summary_of_null_measures(spark):
    df = facts(spark, fact("A", 0, None, None, None), fact("B", 0, None, None, None))
    assert rows(global_summary(df)) == [ZEROS]
    assert rows(global_summary_latest(df, SPEC)) == [ZEROS]


def test_latest_summary_skips_rows_without_recoveries_in_active(spark):
    df = facts(spark, fact("A", 0, 10, 1, None), fact("B", 0, 20, 1, 5))
    assert rows(global_summary_latest(df, SPEC)) == [(30, 2, 5, 15, 5 / 30, 15 / 30)]


def test_missing_recoveries_count_as_zero(tied):
    got = rows(global_summary_latest(tied.drop("Recoveries"), SPEC))
    assert got == [(64, 4, 0, 64, 0.0, 1.0)]


def test_given_active_wins(tied):
    got = rows(global_summary_latest(tied.withColumn("Active", F.lit(5)), SPEC))
    assert got == [(64, 4, 31, 15, 31 / 64, 15 / 64)]


def test_null_key_counts_only_where_no_key_is_needed(spark):
    df = facts(spark, fact(None, 9, 100), fact("A", 0, 1))
    assert rows(global_summary(df))[0][0] == 101
    assert rows(global_summary_latest(df, SPEC))[0][0] == 1
    assert rows(latest_date_by_key(df).orderBy("Country")) == [(None, day(9)), ("A", day(0))]
    assert [r[0] for r in rows(region_snapshot(df))] == ["A"]
    assert [r[0] for r in rows(region_snapshot_one_row(df, SPEC))] == ["A"]
    assert rows(key_list(df)) == [("A",)]


def test_daily_totals(tied):
    assert rows(daily_totals(tied)) == [
        (day(0), 10, 1, 4), (day(2), 100, 0, 50), (day(3), 30, 1, 30), (day(5), 54, 5, 9),
    ]


def test_monthly_totals(spark):
    df = facts(spark, fact("B", 0, 1), fact("A", 30, 2), fact("A", 31, 4), fact("A", 0, 8))
    assert rows(monthly_totals(df)) == [
        ("A", "2024-01", 10), ("A", "2024-02", 4), ("B", "2024-01", 1),
    ]


def test_key_list(tied, spark):
    assert rows(key_list(tied)) == [("A",), ("B",), ("C",)]
    assert rows(key_list(spark.createDataFrame([], LOOSE_SCHEMA))) == []


def test_latest_rows_keeps_ties(tied):
    assert sorted(r[-1] for r in rows(latest_rows(tied))) == [2, 3, 5, 6]


def test_latest_rows_with_given_dates(tied):
    got = rows(latest_rows(tied, latest=latest_date_by_key(tied)))
    assert sorted(r[-1] for r in got) == [2, 3, 5, 6]


def test_last_row_takes_the_last_of_ties(tied):
    assert sorted(r[-1] for r in rows(last_row_per_key(tied, SPEC))) == [3, 5, 6]


def test_last_row_without_tiebreak_is_still_one_per_key(tied):
    assert sorted(r[1] for r in rows(last_row_per_key(tied))) == ["A", "B", "C"]


SNAPSHOT = [
    ("B", *PLACES["B"], 30, 1, 30, 0.0),
    ("A", *PLACES["A"], 27, 5, 9, 3.0),
    ("C", *PLACES["C"], 27, 0, 0, 3.0),
]


def test_snapshot_sums_ties(tied):
    assert rows(region_snapshot(tied)) == SNAPSHOT


def test_snapshot_from_rollup_is_the_same(tied):
    assert sorted(rows(snapshot_from_rollup(daily_rollup(tied)))) == sorted(SNAPSHOT)


def test_one_row_snapshot(tied):
    assert rows(region_snapshot_one_row(tied, SPEC)) == [
        ("A", *PLACES["A"], 7, 4.0), ("B", *PLACES["B"], 30, 0.0), ("C", *PLACES["C"], 27, 3.0),
    ]


def test_latest_date_is_of_the_key_not_of_the_place(spark):
    here, there = ("AAA", 1.0, 2.0), ("AAA", 5.0, 6.0)
    df = facts(
        spark,
        fact("A", 1, 10, place=here),
        fact("A", 4, 20, place=here),
        fact("A", 4, 5, place=there),
        fact("A", 3, 99, place=there),
        fact("B", 2, 1),
    )
    got = [(r[0], r[2], r[4]) for r in rows(region_snapshot(df))]
    assert got == [("A", 1.0, 20), ("A", 5.0, 5), ("B", -3.5, 1)]


def test_place_absent_on_the_latest_date_has_no_row(spark):
    df = facts(
        spark, fact("A", 9, 1, place=("AAA", 1.0, 1.0)), fact("A", 2, 7, place=("AAA", 2.0, 2.0))
    )
    assert [r[2] for r in rows(region_snapshot(df))] == [1.0]


def test_snapshot_null_measures(spark):
    df = facts(
        spark,
        fact("A", 1, None, None, None, None),
        fact("B", 1, None, 1, 2, None),
        fact("B", 1, 5, None, None, 4.0),
    )
    got = {r[0]: r[4:] for r in rows(region_snapshot(df))}
    assert got == {"A": (None, None, None, None), "B": (5, 1, 2, 4.0)}


def test_snapshot_of_nothing(spark):
    assert rows(region_snapshot(spark.createDataFrame([], LOOSE_SCHEMA))) == []


@pytest.mark.parametrize("running", [running_total, running_total_two_pass])
def test_running_total(spark, running):
    values = [(day(n), v) for n, v in [(0, 5), (1, None), (30, 7), (31, 0), (400, 1), (9, 2)]]
    df = spark.createDataFrame(values, "Date date, daily_confirmed bigint")
    assert rows(running(df)) == [
        (day(0), 5, 5), (day(1), None, None), (day(9), 2, 7), (day(30), 7, 14), (day(31), 0, 14),
        (day(400), 1, 15),
    ]


def test_key_timelines(tied):
    assert rows(key_timelines(tied)) == [
        ("A", day(0), 10, 10), ("A", day(5), 27, 37), ("B", day(2), 100, 100),
        ("B", day(3), 30, 130), ("C", day(5), 27, 27),
    ]
    assert rows(key_timelines(tied, "B")) == [("B", day(2), 100, 100), ("B", day(3), 30, 130)]
    assert rows(key_timelines(tied, "nowhere")) == []


def test_monthly_growth_uses_the_previous_month_present(spark):
    df = spark.createDataFrame(
        [("A", "2024-01", 100), ("A", "2024-04", 150), ("A", "2024-05", 0), ("A", "2024-06", 3),
         ("B", "2024-02", 8)],
        "Country string, month string, monthly_confirmed bigint",
    )
    assert rows(monthly_growth(df)) == [
        ("A", "2024-01", 100, None, None), ("A", "2024-04", 150, 100, 50.0),
        ("A", "2024-05", 0, 150, -100.0), ("A", "2024-06", 3, 0, None),
        ("B", "2024-02", 8, None, None),
    ]


def test_daily_delta(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 3), 4), (date(2024, 1, 1), 9)], "Date date, daily_confirmed bigint"
    )
    assert rows(daily_delta(df)) == [(date(2024, 1, 1), 9, None), (date(2024, 1, 3), 4, -5)]


def test_top_k_settles_ties_by_key(tied):
    snap = snapshot_rows(tied)
    assert rows(top_k(snap, 2)) == [("B", 30, 0.0), ("A", 27, 3.0)]
    assert len(rows(top_k(snap, 10))) == 3


def test_lookup(tied):
    snap = snapshot_rows(tied)
    assert rows(lookup(snap, "A"))[0][4] == 27
    assert rows(lookup(snap, "nowhere")) == []


def test_summaries_of_several_variants_share_the_last_rows(spark):
    spec = PanelSpec(tiebreak=("id",))
    table = facts(
        spark,
        fact("A", 0, 100, 1, 50, id=1),
        fact("A", 1, 7, 2, 3, id=2),
        fact("A", 1, 9, 4, 5, id=3),
        fact("B", 0, 20, 6, 1, id=4),
    ).withColumn("Active", F.lit(2))
    kept = {
        "plain": [c for c in table.columns if c != "Active"],
        "no_recoveries": [c for c in table.columns if c not in ("Active", "Recoveries")],
        "ready": table.columns,
    }
    both = summaries_latest(table, kept, spec)
    expected = [
        (name, *rows(global_summary_latest(table.select(*columns), spec))[0])
        for name, columns in kept.items()
    ]
    assert rows(both) == expected
    none = summaries_latest(table.limit(0), {"plain": kept["plain"]}, spec)
    assert rows(none) == [("plain", 0, 0, 0, 0, 0.0, 0.0)]
    with pytest.raises(ValueError, match="tiebreak"):
        summaries_latest(table, kept)
