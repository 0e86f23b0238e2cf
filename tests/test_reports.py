"""Reports, the one-pass dashboard, and delivery."""

import os
import shutil
from pathlib import Path

import pytest
from conftest import TESTDATA
from helpers import LOOSE_SCHEMA, day, fact, facts, rows

from pyspark.sql import functions as F

from dayfold.operators.snapshot import snapshot_rows
from dayfold.operators.totals import global_summary, global_summary_latest, sum_by_day
from dayfold.plans import reports
from dayfold.plans.registry import QUERIES
from dayfold.schema import DIMENSION_SCHEMA, FACT_SCHEMA
from dayfold.sources.shipments import TABLES, Shipments
from dayfold.sources.sinks import is_empty, one_row, settled, write_facts, write_table
from dayfold.sources.stored import STORED_SPEC, stored_facts
from dayfold.sources.tables import facts_from_rows, read_facts

SF = f"{TESTDATA}/sf0.01"


def summary(spark, confirmed, deaths, recoveries):
    return global_summary(facts(spark, fact("A", 0, confirmed, deaths, recoveries)))


@pytest.mark.parametrize(
    "confirmed,recoveries,risk",
    [(1000, 880, "MEDIUM"), (1000, 879, "HIGH"), (1000, 950, "LOW"), (1000, 949, "MEDIUM"),
     (0, 0, "LOW"), (1000, 1000, "LOW")],
)
def test_headline_risk(spark, confirmed, recoveries, risk):
    assert rows(reports.headline_kpis(summary(spark, confirmed, 1, recoveries)))[0][0] == risk


def test_headline_texts(spark):
    got = rows(reports.headline_kpis(summary(spark, 1_250_000, 999, 35_500)))
    assert got == [("HIGH", "1.2M", "999.0", "35.5K")]


def test_headline_of_nothing(spark):
    empty = global_summary(spark.createDataFrame([], LOOSE_SCHEMA))
    assert rows(reports.headline_kpis(empty)) == [("LOW", "0.0", "0.0", "0.0")]


@pytest.fixture
def small(spark):
    return facts(
        spark,
        fact("A", 0, 1000, 1, 500, 1.25),
        fact("A", 1, 1234567, 2, 234567, 12.25),
        fact("B", 1, 10, 0, 5, 0.35),
    )


def test_map_points(small):
    assert rows(reports.map_points(snapshot_rows(small))) == [
        ("A", 1.0, 2.0, 1234567, 12.25, "1.00", "2.00", "1,234,567", "12.2"),
        ("B", -3.5, 4.25, 10, 0.35, "-3.50", "4.25", "10", "0.3"),
    ]


def test_key_detail(small):
    assert rows(reports.key_detail(small, "A")) == [("A", "1,234,567", "12.2", "1.00", "2.00")]
    assert rows(reports.key_detail(small, "nowhere")) == []


def test_global_rate_counts_people_once(spark):
    dim = spark.createDataFrame(
        [(0, "A", "AAA", 1.0, 2.0, 300_000), (1, "B", "BBB", 0.0, 0.0, 100_000),
         (2, "Q", "QQQ", 0.0, 0.0, 900_000_000)],
        DIMENSION_SCHEMA,
    )
    here, there = ("AAA", 1.0, 2.0), ("AAA", 5.0, 6.0)
    df = facts(
        spark,
        fact("A", 0, 999, 0, 0),
        fact("A", 1, 50, 0, 10, place=here),
        fact("A", 1, 30, 0, 10, place=there),
        fact("B", 0, 20, 0, 0),
    )
    assert rows(reports.global_active_per_100k(snapshot_rows(df), dim)) == [(80, 400_000, 20.0)]


def test_emptiness(spark, small):
    got = rows(reports.emptiness({"some": small, "none": small.where("Country = 'Q'")}))
    assert sorted(got) == [("none", True), ("some", False)]
    assert is_empty(small.where("Country = 'Q'")) and not is_empty(small)


PAGE = {
    "summary": "global_summary_all",
    "headline": "headline_kpis",
    "trend": "global_trend",
    "snapshot": "region_snapshot",
    "map": "map_points",
    "monthly": "monthly_totals",
    "keys": "key_list",
    "top": "top10_keys",
    "timelines": "all_key_timelines",
    "growth": "monthly_growth",
    "delta": "daily_delta",
    "global_rate": "global_active_per_100k",
}


def close(left, right):
    return len(left) == len(right) and all(
        all(
            a == pytest.approx(b, abs=1e-5) if isinstance(a, float) else a == b
            for a, b in zip(l, r, strict=True)
        )
        for l, r in zip(left, right)
    )


def test_dashboard_equals_the_single_queries(spark, shared_dir):
    ship = Shipments(spark, SF)
    with reports.dashboard(ship.facts, ship.nations) as page:
        assert set(page) == set(PAGE)
        for name, query in PAGE.items():
            expected = QUERIES[query](spark, SF)
            assert page[name].columns == expected.columns
            assert close(rows(page[name]), rows(expected)), name


def test_dashboard_reads_a_copy_that_goes_with_it(spark, tmp_path):
    ship = Shipments(spark, SF)
    with reports.dashboard(ship.facts, ship.nations, str(tmp_path)) as page:
        files = page["monthly"].inputFiles()
        assert files and all(str(tmp_path) in f for f in files)
        assert list((tmp_path / "dayfold").iterdir())
    assert not list((tmp_path / "dayfold").iterdir())


def test_settled_keeps_rows_and_types(spark, shared_dir):
    daily = sum_by_day(Shipments(spark, SF).measures)
    with settled(daily) as copy:
        assert copy.schema.simpleString() == daily.schema.simpleString()
        assert sorted(rows(copy)) == sorted(rows(daily))
        assert all(shared_dir.removeprefix("file://") in f for f in copy.inputFiles())


def test_settling_without_a_folder_is_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError, match="folder"), settled(spark.range(3)):
        pass


def test_stored_facts_are_written_once_for_what_the_sources_hold(spark, tmp_path):
    source, folder = tmp_path / "source", str(tmp_path / "stored")
    source.mkdir()
    for name in TABLES:
        shutil.copyfile(f"{SF}/{name}.parquet", source / f"{name}.parquet")
    expected = sorted(map(str, rows(QUERIES["region_snapshot"](spark, SF))))

    def stored():
        path = stored_facts(Shipments(spark, str(source)), "month", folder)
        facts = read_facts(spark, path, STORED_SPEC.month)
        return path, sorted(map(str, rows(snapshot_rows(facts, STORED_SPEC).withColumn(
            "active_per_100k", F.round("active_per_100k", 6)
        ))))

    path, first = stored()
    written = {p: p.stat().st_mtime_ns for p in Path(path).rglob("part-*")}
    again, second = stored()
    assert (path, first) == (again, second) and first == expected and len(written) > 12
    assert written == {p: p.stat().st_mtime_ns for p in Path(path).rglob("part-*")}
    # A write that broke off is not read, and another source is another table.
    (Path(path) / "_SUCCESS").unlink()
    next(iter(written)).unlink()
    assert stored() == (path, expected)
    os.utime(source / "lineitem.parquet", (1, 1))
    assert stored()[0] != path


# Files that differ from what is declared.


def test_a_missing_required_column_is_refused(spark, small, tmp_path):
    path = str(tmp_path / "facts")
    small.drop("Confirmed").write.parquet(path)
    with pytest.raises(ValueError, match="Confirmed"):
        read_facts(spark, path)


def test_a_missing_optional_column_is_left_out(spark, small, tmp_path):
    path = str(tmp_path / "facts")
    small.drop("Recoveries", "id").write.parquet(path)
    read = read_facts(spark, path)
    assert "Recoveries" not in read.columns
    assert rows(global_summary_latest(read)) == rows(global_summary_latest(small.drop("Recoveries")))
    assert rows(global_summary_latest(read))[0][3:] == (1_234_577, 0.0, 1.0)


def test_a_ready_active_column_is_read(spark, small, tmp_path):
    path = str(tmp_path / "facts")
    small.withColumn("Active", F.lit(7)).write.parquet(path)
    assert rows(global_summary_latest(read_facts(spark, path)))[0][3] == 14


@pytest.fixture(scope="module")
def orphan_dir(spark, tmp_path_factory):
    """A fifth of the lines name a supplier that does not exist."""
    path = tmp_path_factory.mktemp("orphans")
    for name in ("nation", "supplier", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lost = F.when(F.col("l_orderkey") % 5 == 0, F.lit(-1).cast("bigint"))
    lines = lines.withColumn("l_suppkey", F.coalesce(lost, "l_suppkey"))
    lines.write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_lines_without_a_place_count_where_no_key_is_needed(spark, orphan_dir):
    def total(name, column):
        return QUERIES[name](spark, orphan_dir).agg(F.sum(column)).collect()[0][0]

    whole = total("daily_totals", "daily_confirmed")
    assert total("monthly_totals", "monthly_confirmed") == whole
    assert total("fact_rows", "Confirmed") == whole
    assert rows(QUERIES["global_summary_all"](spark, orphan_dir))[0][0] == whole
    for name in ("key_list", "latest_date_by_key", "region_snapshot", "latest_rows"):
        df = QUERIES[name](spark, orphan_dir)
        assert df.where("Country IS NULL").count() == 0 < df.count()


def test_global_rate_counts_cases_of_keys_the_dimension_lacks(spark):
    dim = spark.createDataFrame([(0, "A", "AAA", 1.0, 2.0, 100_000)], DIMENSION_SCHEMA)
    df = facts(spark, fact("A", 0, 10), fact("B", 0, 30))
    assert rows(reports.global_active_per_100k(snapshot_rows(df), dim)) == [(40, 100_000, 40.0)]


def test_fact_table_round_trip(spark, tmp_path):
    path = str(tmp_path / "facts")
    data = [(day(n), k, k * 3, 1.0, 2.0, n, 0, 0, 0.5) for n in range(40) for k in "XY"]
    original = facts_from_rows(spark, data)
    assert original.schema == FACT_SCHEMA
    write_facts(original, path)
    back = read_facts(spark, path)
    assert back.columns == FACT_SCHEMA.names and sorted(rows(back)) == sorted(data)
    with pytest.raises(Exception, match="already exists"):
        write_facts(original, path)


def test_null_in_a_declared_column_is_refused(spark):
    with pytest.raises(Exception, match="not nullable|NOT_NULL|not None|null"):
        facts_from_rows(spark, [(day(0), None, "X", 1.0, 2.0, 1, 0, 0, 0.5)])


def test_delivery(spark, tmp_path):
    df = summary(spark, 10, 1, 5)
    assert one_row(df) == {
        "total_confirmed": 10, "total_deaths": 1, "total_recoveries": 5, "total_active": 5,
        "recovery_rate": 0.5, "active_rate": 0.5,
    }
    with pytest.raises(ValueError):
        one_row(spark.range(2))
    write_table(df, str(tmp_path / "summary"))
    assert spark.read.parquet(str(tmp_path / "summary")).count() == 1
