"""Every registered query against its SQL oracle, on whole tables."""

import duckdb
import pytest
from conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from dayfold.plans.oracle import ORACLE
from dayfold.plans.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Column types that may stand for each other between the engines.
KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(row[i] for i in order) for row in rows]


def check(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = duck(sf_dir).sql(ORACLE[name])
    assert sorted(df.columns) == sorted(result.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {c: KIND[str(t)] for c, t in zip(result.columns, result.types)}
    assert spark_types == duck_types
    ours = by_name(df.columns, [tuple(r) for r in df.collect()])
    theirs = by_name(result.columns, result.fetchall())
    assert len(ours) == len(theirs)

    def key(row):
        return tuple((v is None, v if v is not None else 0) for v in row)

    assert sorted(ours, key=key) == sorted(theirs, key=key)
    return len(ours)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name, sf):
    check(spark, name, f"{TESTDATA}/{sf}")


def test_entry(spark):
    df = entry(spark)
    assert df.columns == [
        "Date", "daily_confirmed", "daily_deaths", "daily_recoveries", "cumulative_confirmed",
    ]
    assert df.count() > 0


SORTED = [
    "daily_totals", "monthly_totals", "key_list", "region_snapshot", "region_snapshot_rollup",
    "region_snapshot_one_row", "global_trend", "global_trend_two_pass", "key_timeline",
    "all_key_timelines", "monthly_growth", "daily_delta", "top10_keys",
]


@pytest.mark.parametrize("name", SORTED)
def test_order_matches_oracle(spark, name):
    sf_dir = f"{TESTDATA}/sf0.01"
    df = QUERIES[name](spark, sf_dir)
    result = duck(sf_dir).sql(ORACLE[name])
    ours = by_name(df.columns, [tuple(r) for r in df.collect()])
    assert ours == by_name(result.columns, result.fetchall())
