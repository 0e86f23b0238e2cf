"""Running totals and changes worked through by range, against the plain forms."""

import random
import re

import pytest
from helpers import day, plan, rows
from pyspark.sql import functions as F

from dayfold.operators.cumulative import daily_delta, running_total
from dayfold.operators.ranges import delta_in_ranges, in_ranges, running_total_in_ranges

SCHEMA = "Date date, daily_confirmed bigint"


def grids():
    rng = random.Random(6)
    some = [(day(n), rng.choice([None, 0, rng.randrange(1_000)])) for n in rng.sample(range(900), 400)]
    return {
        "some": some,
        "one": [(day(3), 4)],
        "none": [],
        "no date": [(None, 5), (day(1), 2), (day(2), None), (day(4), 1)],
        "nulls": [(day(n), None) for n in range(5)],
    }


@pytest.mark.parametrize("name", grids())
def test_ranges_equal_the_plain_forms(spark, conf, name):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    grid = spark.createDataFrame(grids()[name], SCHEMA).repartition(3)
    assert rows(running_total_in_ranges(grid)) == rows(running_total(grid))
    assert rows(delta_in_ranges(grid)) == rows(daily_delta(grid))


def test_a_grid_of_seconds_is_spread(spark, conf):
    conf(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    n = 400_000
    grid = spark.range(n).select(
        F.timestamp_seconds("id").alias("Date"), (F.col("id") % 7).alias("daily_confirmed")
    )
    sizes = [r[1] for r in in_ranges(grid, "Date").groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * n / 16
    total, delta = running_total_in_ranges(grid), delta_in_ranges(grid)
    # One row for each range is all that a single task sees.
    for df in (total, delta):
        single = re.findall(r"Exchange SinglePartition.*\n(.*)", plan(df))
        assert len(single) == 1 and "HashAggregate(keys=[_range" in single[0] or "SortAggregate" in single[0]
    id = F.unix_seconds("Date")
    weeks, rest = F.floor(id / 7), id % 7
    right = F.col("cumulative_confirmed") == 21 * weeks + F.floor(rest * (rest + 1) / 2)
    assert total.where(right).count() == n
    change = F.when(id > 0, F.when(rest == 0, -6).otherwise(1))
    assert delta.where(F.col("delta_confirmed").eqNullSafe(change)).count() == n
