"""What reaches the scan, what is shuffled, and what happens with skew."""

import re

import pytest
from conftest import TESTDATA
from helpers import day, plan, rows
from pyspark.sql import functions as F

from dayfold.operators.cumulative import key_timelines
from dayfold.operators.latest import known_latest, last_row_per_key, latest_date_by_key
from dayfold.operators.panel import dense_panel
from dayfold.operators.snapshot import region_snapshot, snapshot_rows
from dayfold.operators.totals import global_summary, monthly_totals, sum_by_day
from dayfold.plans.registry import QUERIES
from dayfold.plans.reports import key_detail, top_keys
from dayfold.schema import FACT_SCHEMA
from dayfold.sources.countries import country_entries
from dayfold.sources.shipments import Shipments
from dayfold.sources.sinks import write_facts
from dayfold.sources.stored import STORED_SPEC, stored_facts
from dayfold.sources.tables import first_n_keys, keep_keys, read_facts

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The shipment facts written as a fact table."""
    path = str(tmp_path_factory.mktemp("facts") / "facts")
    write_facts(Shipments(spark, SF).facts.select(*FACT_SCHEMA.names), path)
    return read_facts(spark, path)


def read_columns(text):
    return [
        sorted(c.split(":")[0] for c in schema.split(",") if c)
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    if name.endswith("in_ranges"):  # from a checkpoint, whose plan is what it has stored
        text = text.replace("Scan ExistingRDD", "")
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "RDD"):
        assert forbidden not in text


def test_summary_reads_three_columns_without_a_shuffle_of_rows(table):
    text = plan(global_summary(table))
    assert read_columns(text) == [["Confirmed", "Deaths", "Recoveries"]]
    assert "partial_sum" in text and "hashpartitioning" not in text


def test_summary_of_lines_joins_nothing(spark):
    text = plan(QUERIES["global_summary_all"](spark, SF))
    assert "Join" not in text and len(read_columns(text)) == 1


def test_unused_population_is_not_computed(spark):
    text = plan(QUERIES["monthly_totals"](spark, SF))
    assert "customer" not in text
    assert "customer" in plan(QUERIES["region_snapshot"](spark, SF))


def test_key_filter_reaches_the_scan(table):
    text = plan(key_timelines(table, "NATION_8"))
    assert "EqualTo(Country,NATION_8)" in text
    assert read_columns(text) == [["Confirmed", "Country", "Date"]]
    scans = re.findall(r"FileScan.*", plan(key_detail(table, "NATION_8")))
    assert len(scans) >= 2 and all("EqualTo(Country,NATION_8)" in scan for scan in scans)


def test_key_filter_reaches_the_dimension(spark):
    assert "EqualTo(n_name,NATION_8)" in plan(QUERIES["key_timeline"](spark, SF))


def test_snapshot_scans_recent_rows_only(table):
    text = plan(region_snapshot(table))
    assert "GreaterThanOrEqual(Date,ScalarSubquery" in text
    assert ["Country", "Date"] in read_columns(text)
    assert "LeftSemi" in text


def test_last_row_is_limited_before_the_shuffle(table):
    text = plan(last_row_per_key(table))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")
    # Rows are ranked after they are matched with their key's latest date.
    assert text.index("Partial") < text.index("LeftSemi")


def ranked_rows(df):
    """Rows that reached the window group limit of a query that was run."""
    df.collect()
    top = df._jdf.queryExecution().executedPlan()
    found, todo = [], [top]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith(("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("dormant", [False, True])
def test_a_dormant_key_ranks_its_own_rows_only(spark, dormant):
    rows_of = [(day(d), f"K{k}", d * k) for d in range(100) for k in range(20)]
    if dormant:
        rows_of.append((day(0), "old", 1))
    df = spark.createDataFrame(rows_of, "Date date, Country string, Confirmed int")
    last = last_row_per_key(df)
    assert ranked_rows(last) == [20 + dormant]
    assert last.count() == 20 + dormant


def test_date_bound_reaches_the_scan_of_timestamps(spark):
    for name in ("region_snapshot", "region_snapshot_one_row", "key_detail", "latest_rows"):
        text = plan(QUERIES[name](spark, SF))
        assert "GreaterThanOrEqual(l_shipdate,20" in text, name


def scanned_rows(df, column):
    """Rows that came out of each scan of a column, for a query that is run here."""
    df.collect()
    read, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if "Scan parquet" in node.nodeName() and column in node.simpleString(99):
            read.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return read


def test_date_bound_skips_row_groups_of_clustered_facts(spark, table, tmp_path):
    """By dates; Spark's Parquet reader does not skip by bounds on TIMESTAMP_NTZ."""
    path = str(tmp_path / "clustered")
    table.repartitionByRange(20, "Date").write.parquet(path)
    read = scanned_rows(region_snapshot(read_facts(spark, path)), "Confirmed")
    assert len(read) == 1 and read[0] < table.count() / 5


LATEST_QUERIES = [
    "region_snapshot", "region_snapshot_one_row", "latest_rows", "map_points", "map_points_one_row",
    "top10_keys", "global_active_per_100k", "global_summary_latest", "headline_kpis_latest",
]


@pytest.mark.parametrize("name", LATEST_QUERIES)
def test_latest_queries_read_lines_twice(spark, monkeypatch, name):
    """Once narrowly, for the dates, and once from the earliest of these on."""
    scans = []

    def spied(latest, most=10_000):
        scans.extend(scanned_rows(latest, "l_shipdate"))
        return known_latest(latest, most)

    monkeypatch.setattr("dayfold.sources.shipments.known_latest", spied)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    df = QUERIES[name](spark, SF)
    assert scans == [lines]
    assert len(scanned_rows(df, "l_shipdate")) == 1


def test_many_keys_stay_in_the_cluster(spark, table):
    latest = latest_date_by_key(table)
    assert known_latest(latest, most=5) is latest
    few, many = known_latest(latest), latest
    expected = sorted(map(str, rows(snapshot_rows(table))))
    assert sorted(map(str, rows(snapshot_rows(table, latest=few)))) == expected
    assert sorted(map(str, rows(snapshot_rows(table, latest=many)))) == expected
    none = known_latest(latest_date_by_key(table.limit(0)))
    assert rows(snapshot_rows(table, latest=none)) == []
    assert few.of("NATION_8").table.count() == 1


# The stored table


@pytest.mark.parametrize("known", [True, False])
def test_a_table_split_by_month_opens_few_folders(spark, known):
    path = stored_facts(Shipments(spark, SF), "month")
    facts = read_facts(spark, path, STORED_SPEC.month)
    latest = known_latest(latest_date_by_key(facts)) if known else None
    df = snapshot_rows(facts, STORED_SPEC, latest)
    text = plan(df)
    wide = next(scan for scan in re.findall(r"FileScan.*", text) if "Confirmed" in scan)
    filters = re.search(r"PartitionFilters: \[([^\]]*)", wide).group(1)
    assert "month" in filters and (known or "subquery" in wide.lower())
    df.collect()
    opened, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if "Scan parquet" in node.nodeName() and "Confirmed" in node.simpleString(99):
            opened.append(node.metrics().apply("numPartitions").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    months = facts.select("month").distinct().count()
    assert months > 80 and opened and max(opened) <= 4


@pytest.mark.parametrize("name, grouped", [("stored_extent", ""), ("stored_latest_dates", "Country")])
def test_counts_and_bounds_come_from_footers(spark, name, grouped):
    text = plan(QUERIES[name](spark, SF))
    assert "PushedAggregation: [COUNT(*), MIN(Date), MAX(Date)]" in text
    assert f"PushedGroupBy: [{grouped}]" in text
    # The session of the footers is another one.
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


@pytest.mark.parametrize("name", ["first_n_keys", "key_timeline", "key_detail"])
def test_lines_of_other_suppliers_are_filtered_before_the_shuffle(spark, conf, name):
    expected = sorted(map(str, rows(QUERIES[name](spark, SF))))
    conf(
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        }
    )
    df = QUERIES[name](spark, SF)
    assert re.search(r"might_contain[^\n]*l_suppkey", plan(df))
    assert sorted(map(str, rows(df))) == expected


ONE_NATION = "4KB"  # admits a nation's four suppliers, not all of the hundred


@pytest.mark.parametrize("name", ["key_timeline", "key_detail", "emptiness"])
def test_one_key_shuffles_no_line_for_the_join(spark, conf, name):
    expected = sorted(map(str, rows(QUERIES[name](spark, SF))))
    conf(**{"spark.sql.autoBroadcastJoinThreshold": ONE_NATION})
    df = QUERIES[name](spark, SF)
    text = plan(df)
    assert sorted(map(str, rows(df))) == expected
    for join in re.findall(r"SortMergeJoin[^\n]*", text):
        assert "l_suppkey" not in join
    assert "EqualTo(n_name,NATION_8)" in text


def test_lines_join_places_that_are_flat(spark, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    text = plan(QUERIES["first_n_keys"](spark, SF))
    lines, cut = text.index("l_shipdate"), text.index("TakeOrderedAndProject")
    assert text.count("SortMergeJoin") >= 2 and lines < cut


def test_top_k_does_not_sort_everything(table):
    text = plan(top_keys(snapshot_rows(table)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_timelines_shuffle_sums_not_facts(table):
    text = plan(key_timelines(table))
    assert text.count("Exchange") == 2 and "partial_sum" in text
    assert text.index("rangepartitioning(Country") < text.index("hashpartitioning(Country")


def test_totals_run_in_one_pass(table):
    text = plan(sum_by_day(table))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_dense_panel_is_spread_by_size(spark, conf):
    conf(
        **{
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        }
    )
    p = dense_panel(country_entries(spark).limit(84).repartition(8), 1000, "2024-03-10")
    assert "Join" not in plan(p) and "REBALANCE_PARTITIONS" in plan(p)
    per_task = [n for (_, n) in rows(p.groupBy(F.spark_partition_id()).count())]
    assert len(per_task) > 4 and sum(per_task) == 84_000 and max(per_task) < 84_000 / 3


def test_subset_of_keys_is_a_semi_join(spark, table):
    dim = Shipments(spark, SF).nations
    text = plan(keep_keys(table, first_n_keys(dim, 3)))
    assert "LeftSemi" in text and "TakeOrderedAndProject" in text


# A supplier, and with it a nation, that holds a third of all lines.


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("skewed")
    for name in ("nation", "supplier", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
    lines.withColumn(
        "l_suppkey", F.when(hot, F.lit(7).cast("bigint")).otherwise(F.col("l_suppkey"))
    ).repartition(8).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


SKEW_QUERIES = [
    "monthly_totals", "region_snapshot", "region_snapshot_rollup", "region_snapshot_one_row",
    "latest_rows", "all_key_timelines", "global_summary_latest", "key_list", "top10_keys",
]


@pytest.mark.parametrize("name", SKEW_QUERIES)
def test_results_do_not_depend_on_the_join_strategy(spark, conf, skewed_dir, name):
    query = QUERIES[name]
    broadcast = sorted(map(str, rows(query(spark, skewed_dir))))
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    shuffled = query(spark, skewed_dir)
    assert sorted(map(str, rows(shuffled))) == broadcast and broadcast
    assert "SortMergeJoin" in plan(shuffled)


def test_hot_supplier_is_split(spark, conf, skewed_dir):
    def by_lines():
        return monthly_totals(Shipments(spark, skewed_dir).facts)

    expected = rows(by_lines())
    conf(
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        }
    )
    df = by_lines()
    assert rows(df) == expected
    assert "SortMergeJoin(skew=true)" in plan(df)


def test_months_are_summed_before_the_supplier_join(spark, conf, skewed_dir):
    expected = rows(monthly_totals(Shipments(spark, skewed_dir).facts))
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = QUERIES["monthly_totals"](spark, skewed_dir)
    text = plan(df)
    assert rows(df) == expected
    join, scan = text.index("SortMergeJoin"), text.index("l_quantity")
    assert "partial_sum(Confirmed" in text[join:scan]


def test_hot_key_is_spread_over_files(spark, conf, skewed_dir, tmp_path):
    conf(
        **{
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        }
    )
    path = str(tmp_path / "facts")
    facts = Shipments(spark, skewed_dir).facts.select(*FACT_SCHEMA.names)
    write_facts(facts, path)
    written = read_facts(spark, path)
    assert written.count() == facts.count()
    per_file = written.groupBy(F.input_file_name()).count().agg(F.max("count")).collect()[0][0]
    hot = written.groupBy("Country").count().agg(F.max("count")).collect()[0][0]
    assert hot > written.count() / 3 and per_file < hot / 2
