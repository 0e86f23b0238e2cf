"""The queries the driver runs; each reads the whole tables of a directory.

Averages and percentages are rounded to six decimals here, not in the
operators, because a sum of doubles depends on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.formats import fixed_decimals, human_number, thousands
from dayfold.functions.measures import active, per_capita_rate, truncate_at_zero
from dayfold.operators import cumulative, latest, panel, ranges, snapshot, totals
from dayfold.operators.latest import known_latest
from dayfold.plans import reports
from dayfold.schema import FACT_SCHEMA, PanelSpec
from dayfold.sources.shipments import SHIPMENT_SPEC, SITE_SPEC, Shipments
from dayfold.sources.stored import STORED_SPEC, footer_extent, footer_total, stored_facts
from dayfold.sources.tables import dedup_dimension, first_n_keys, keep_keys, read_facts

Query = Callable[[Shipments], DataFrame]

KEY = "NATION_8"
ABSENT_KEY = "NATION_99"
FIRST_KEYS = 10
PANEL_DAYS = 180

DIGITS = 6


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in columns})


def places(ship: Shipments) -> DataFrame:
    """The ties-summed snapshot that several reports start from."""
    return snapshot.snapshot_rows(ship.facts, SHIPMENT_SPEC, ship.known_latest)


def last_rows_summary(ship: Shipments) -> DataFrame:
    return totals.global_summary_latest(ship.facts, SHIPMENT_SPEC, ship.known_latest)


# Sources and layout


def fact_rows(ship):
    return ship.facts.select(*FACT_SCHEMA.names)


def dim_dedup(ship):
    """Customers taken as repeated entries of their nation."""
    entries = ship.table("customer").selectExpr(
        "c_custkey AS ordinal", "c_nationkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    return dedup_dimension(entries, PanelSpec(key="c_nationkey"))


def first_keys(ship):
    """The nations are cut before lines are looked up."""
    chosen = first_n_keys(ship.nations, FIRST_KEYS)
    kept = ship.facts_at(keep_keys(ship.places_in(chosen), chosen))
    return kept.select("Date", "Country", "Confirmed", *SHIPMENT_SPEC.tiebreak)


def calendar_panel(ship):
    dense = panel.dense_panel(ship.sites, PANEL_DAYS, ship.last_date, SITE_SPEC)
    return dense.select("Date", "day_index", *SITE_SPEC.place)


def truncated_margins(ship):
    """Discount less the quantity's worth of one each, in whole units and not below 0."""
    margin = F.col("l_extendedprice") * F.col("l_discount") - 40.0 * F.col("l_quantity")
    return ship.table("lineitem").select(
        *SHIPMENT_SPEC.tiebreak, truncate_at_zero(margin, "bigint").alias("margin")
    )


def per_capita(ship):
    confirmed, recoveries = F.col("Confirmed"), F.col("Recoveries")
    rate = per_capita_rate(confirmed, recoveries, F.col("Population"))
    return ship.facts.select(
        "Date",
        "Country",
        *SHIPMENT_SPEC.tiebreak,
        active(confirmed, recoveries).alias("active"),
        rate.alias("rate"),
        fixed_decimals(rate, 1).alias("rate_label"),
    )


# Aggregates


def global_summary_all(ship):
    return rounded(totals.global_summary(ship.measures), "recovery_rate", "active_rate")


def global_summary_latest(ship):
    return rounded(last_rows_summary(ship), "recovery_rate", "active_rate")


def global_summary_optional_cols(ship):
    """Once without recoveries, once with a ready active column."""
    facts = ship.facts.withColumn("Active", F.col("Confirmed") - F.col("Deaths"))
    variants = {
        "no_recoveries": [c for c in facts.columns if c not in ("Recoveries", "Active")],
        "active_given": facts.columns,
    }
    both = totals.summaries_latest(facts, variants, SHIPMENT_SPEC, ship.known_latest)
    return rounded(both, "recovery_rate", "active_rate")


def daily_totals(ship):
    return totals.daily_totals(ship.measures)


def latest_date_by_key(ship):
    return ship.latest


def monthly_totals(ship):
    return totals.monthly_totals(ship.monthly_facts)


def key_list(ship):
    return totals.key_list(ship.latest)


# Latest rows and snapshots


def latest_rows(ship):
    rows = latest.latest_rows(ship.facts, SHIPMENT_SPEC, ship.known_latest)
    return rows.select(*FACT_SCHEMA.names, *SHIPMENT_SPEC.tiebreak)


def region_snapshot(ship):
    return rounded(snapshot.by_size(places(ship)), "active_per_100k")


def region_snapshot_rollup(ship):
    rollup = snapshot.daily_rollup(ship.facts)
    return rounded(snapshot.by_size(snapshot.snapshot_from_rollup(rollup)), "active_per_100k")


def region_snapshot_one_row(ship):
    return snapshot.region_snapshot_one_row(ship.facts, SHIPMENT_SPEC, ship.known_latest)


def stored_snapshot(ship):
    """The snapshot of the fact table as it is stored, by month: only the folders of the
    months that hold a latest date are opened."""
    facts = read_facts(ship.spark, stored_facts(ship, "month"), STORED_SPEC.month)
    return rounded(snapshot.snapshot_rows(facts, STORED_SPEC), "active_per_100k")


def stored_latest_dates(ship):
    """Days, rows and dates of each key from the file footers of the table split by key."""
    return footer_extent(ship.spark, stored_facts(ship, "key"), STORED_SPEC)


def stored_extent(ship):
    """Rows, first and last date of all facts, and whether there are none, from footers."""
    return footer_total(ship.spark, stored_facts(ship, "month"), STORED_SPEC)


# Running totals and changes


def global_trend(ship):
    return reports.global_trend(ship.measures)


def global_trend_two_pass(ship):
    return cumulative.running_total_two_pass(totals.sum_by_day(ship.measures))


def global_trend_in_ranges(ship):
    return ranges.running_total_in_ranges(totals.sum_by_day(ship.measures))


def key_timeline(ship):
    return cumulative.key_timelines(ship.facts_at(ship.places_of(KEY)), KEY)


def all_key_timelines(ship):
    return cumulative.key_timelines(ship.facts)


def timeline_labels(ship):
    """Every running total as text, in both number formats."""
    running = F.col("cumulative")
    return cumulative.key_timelines(ship.facts).select(
        "Country",
        "Date",
        human_number(running).alias("short"),
        human_number(running * 1_000_000.0).alias("short_scaled"),
        thousands(running).alias("long"),
    )


def monthly_growth(ship):
    growth = cumulative.monthly_growth(totals.sum_by_month(ship.monthly_facts))
    return rounded(growth, "growth_pct")


def daily_delta(ship):
    return cumulative.daily_delta(totals.sum_by_day(ship.measures))


def daily_delta_in_ranges(ship):
    daily = totals.sum_by_day(ship.measures).select("Date", "daily_confirmed")
    return ranges.delta_in_ranges(daily)


# Reports


def headline_kpis(ship):
    return reports.headline_kpis(totals.global_summary(ship.measures))


def headline_kpis_latest(ship):
    return reports.headline_kpis(last_rows_summary(ship))


def map_points(ship):
    return rounded(reports.map_points(places(ship)), "color")


def map_points_one_row(ship):
    return rounded(reports.map_points(region_snapshot_one_row(ship)), "color")


def key_detail(ship):
    known = known_latest(ship.latest.where(F.col("Country") == KEY))
    return reports.key_detail(ship.facts_at(ship.places_of(KEY)), KEY, SHIPMENT_SPEC, known)


def top10_keys(ship):
    return rounded(reports.top_keys(places(ship)), "active_per_100k")


def global_active_per_100k(ship):
    rate = reports.global_active_per_100k(places(ship), ship.nations)
    return rounded(rate, "active_per_100k")


def emptiness(ship):
    return reports.emptiness(
        {
            "facts": ship.measures,
            "key_facts": ship.facts_at(ship.places_of(KEY)),
            "absent_key_facts": ship.facts_at(ship.places_of(ABSENT_KEY)),
        }
    )


def on_directory(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Shipments(spark, sf_dir))


BY_NAME: dict[str, Query] = {
    "fact_rows": fact_rows,
    "dim_dedup": dim_dedup,
    "first_n_keys": first_keys,
    "calendar_panel": calendar_panel,
    "truncated_margins": truncated_margins,
    "per_capita_rate": per_capita,
    "global_summary_all": global_summary_all,
    "global_summary_latest": global_summary_latest,
    "global_summary_optional_cols": global_summary_optional_cols,
    "daily_totals": daily_totals,
    "latest_date_by_key": latest_date_by_key,
    "monthly_totals": monthly_totals,
    "key_list": key_list,
    "latest_rows": latest_rows,
    "region_snapshot": region_snapshot,
    "region_snapshot_rollup": region_snapshot_rollup,
    "region_snapshot_one_row": region_snapshot_one_row,
    "stored_snapshot": stored_snapshot,
    "stored_latest_dates": stored_latest_dates,
    "stored_extent": stored_extent,
    "global_trend": global_trend,
    "global_trend_two_pass": global_trend_two_pass,
    "global_trend_in_ranges": global_trend_in_ranges,
    "key_timeline": key_timeline,
    "all_key_timelines": all_key_timelines,
    "timeline_labels": timeline_labels,
    "monthly_growth": monthly_growth,
    "daily_delta": daily_delta,
    "daily_delta_in_ranges": daily_delta_in_ranges,
    "headline_kpis": headline_kpis,
    "headline_kpis_latest": headline_kpis_latest,
    "map_points": map_points,
    "map_points_one_row": map_points_one_row,
    "key_detail": key_detail,
    "top10_keys": top10_keys,
    "global_active_per_100k": global_active_per_100k,
    "emptiness": emptiness,
}

QUERIES = {name: on_directory(query) for name, query in BY_NAME.items()}
