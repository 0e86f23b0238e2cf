"""Operators against plain Python on random tables."""

import collections

import pytest
from helpers import day, fact, facts, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dayfold.operators.cumulative import key_timelines, running_total, running_total_two_pass
from dayfold.operators.latest import last_row_per_key, latest_rows
from dayfold.operators.snapshot import (
    daily_rollup,
    region_snapshot,
    region_snapshot_one_row,
    snapshot_from_rollup,
)
from dayfold.operators.totals import (
    daily_totals,
    global_summary,
    global_summary_latest,
    monthly_totals,
)
from dayfold.schema import PanelSpec

SPEC = PanelSpec(tiebreak=("id",))
FEW = settings(
    max_examples=12,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

ROW = st.tuples(
    st.sampled_from(["A", "B", "C", None]),
    st.integers(0, 70),
    st.integers(0, 1000),
    st.integers(0, 50),
    st.integers(0, 900),
    st.sampled_from([0.25, 0.5, 1.0, 8.0]),
    st.sampled_from([None, ("XXX", 5.0, 5.0)]),
)
TABLE = st.lists(ROW, max_size=40).map(
    lambda drawn: [
        fact(k, n, c, d, r, rate, id=i, place=place)
        for i, (k, n, c, d, r, rate, place) in enumerate(drawn)
    ]
)

DATE, KEY, CONFIRMED, DEATHS, RECOVERIES, RATE, ID = 0, 1, 5, 6, 7, 8, 9


def summary_of(data):
    c, d, r = (sum(row[i] for row in data) for i in (CONFIRMED, DEATHS, RECOVERIES))
    return (c, d, r, c - r, r / c if c else 0.0, (c - r) / c if c else 0.0)


def last_rows(data):
    last = {}
    for row in sorted((r for r in data if r[KEY] is not None), key=lambda r: (r[DATE], r[ID])):
        last[row[KEY]] = row
    return last


def rows_on_latest_date(data):
    last = last_rows(data)
    return [r for r in data if r[KEY] is not None and r[DATE] == last[r[KEY]][DATE]]


def snapshot_of(data):
    places = collections.defaultdict(list)
    for row in rows_on_latest_date(data):
        places[row[1:5]].append(row)
    out = [
        (
            *place,
            sum(r[CONFIRMED] for r in group),
            sum(r[DEATHS] for r in group),
            sum(r[RECOVERIES] for r in group),
            sum(r[RATE] for r in group) / len(group),
        )
        for place, group in places.items()
    ]
    return sorted(out, key=lambda r: (-r[4], r[:4]))


def sums(data, key):
    totals = collections.Counter()
    for row in data:
        totals[key(row)] += row[CONFIRMED]
    return totals


def with_running(pairs):
    total, out = 0, []
    for name, value in pairs:
        total += value
        out.append((*name, value, total))
    return out


@FEW
@given(data=TABLE)
def test_summaries(spark, data):
    df = facts(spark, *data)
    assert rows(global_summary(df)) == [summary_of(data)]
    assert rows(global_summary_latest(df, SPEC)) == [summary_of(last_rows(data).values())]


@FEW
@given(data=TABLE)
def test_latest(spark, data):
    df = facts(spark, *data)
    assert sorted(r[ID] for r in rows(latest_rows(df))) == [r[ID] for r in rows_on_latest_date(data)]
    expected = last_rows(data)
    assert {r[KEY]: r for r in rows(last_row_per_key(df, SPEC))} == expected
    assert rows(region_snapshot_one_row(df, SPEC)) == [
        (*expected[k][1:5], expected[k][CONFIRMED], expected[k][RATE]) for k in sorted(expected)
    ]


@FEW
@given(data=TABLE)
def test_snapshot(spark, data):
    df = facts(spark, *data)
    expected = snapshot_of(data)
    assert rows(region_snapshot(df)) == expected
    assert sorted(rows(snapshot_from_rollup(daily_rollup(df)))) == sorted(expected)


@FEW
@given(data=TABLE)
def test_totals_and_trend(spark, data):
    df = facts(spark, *data)
    by_day = sorted(sums(data, lambda r: r[DATE]).items())
    daily = daily_totals(df)
    assert [r[:2] for r in rows(daily)] == by_day
    expected = with_running(((d,), v) for d, v in by_day)
    for running in (running_total, running_total_two_pass):
        got = rows(running(daily.select("Date", "daily_confirmed")))
        assert got == expected
    keyed = [r for r in data if r[KEY] is not None]
    by_month = sums(keyed, lambda r: (r[KEY], r[DATE].strftime("%Y-%m")))
    got = rows(monthly_totals(df.where("Country IS NOT NULL")))
    assert got == [(*k, v) for k, v in sorted(by_month.items())]


@FEW
@given(data=TABLE, key=st.sampled_from(["A", "B", "Z"]))
def test_timelines(spark, data, key):
    df = facts(spark, *data)
    by_day = sorted(sums([r for r in data if r[KEY] == key], lambda r: r[DATE]).items())
    expected = with_running(((key, d), v) for d, v in by_day)
    assert rows(key_timelines(df, key)) == expected
    assert [r for r in rows(key_timelines(df)) if r[0] == key] == expected


@pytest.mark.parametrize("partitions", [1, 7])
def test_order_of_input_does_not_matter(spark, partitions):
    data = [fact("ABC"[i % 3], i % 5, i, id=i) for i in range(60)]
    df = facts(spark, *reversed(data)).repartition(partitions)
    assert {r[KEY]: r for r in rows(last_row_per_key(df, SPEC))} == last_rows(data)
    assert [r[1] for r in rows(daily_totals(df))] == [
        v for _, v in sorted(sums(data, lambda r: r[DATE]).items())
    ]
    assert rows(daily_totals(df))[0][0] == day(0)
