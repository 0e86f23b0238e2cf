"""The tables a dashboard page shows, each a composition of operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions.formats import fixed_decimals, human_number, thousands
from dayfold.functions.measures import active, population_units, risk_label
from dayfold.operators.cumulative import (
    daily_delta,
    key_timelines,
    monthly_growth,
    running_total,
)
from dayfold.operators.latest import Latest
from dayfold.operators.ranking import TOP_K, lookup, top_k
from dayfold.operators.snapshot import (
    by_size,
    daily_rollup,
    snapshot_from_rollup,
    snapshot_rows,
)
from dayfold.operators.totals import (
    global_summary,
    key_list,
    monthly_totals,
    sum_by_day,
    sum_by_month,
)
from dayfold.schema import DEFAULT_SPEC, PanelSpec
from dayfold.sources.sinks import settled


def headline_kpis(summary: DataFrame) -> DataFrame:
    """Risk label and three formatted totals from a one-row summary."""
    return summary.select(
        risk_label(F.col("active_rate")).alias("risk_level"),
        human_number(F.col("total_confirmed")).alias("global_cases"),
        human_number(F.col("total_deaths")).alias("deaths"),
        human_number(F.col("total_recoveries")).alias("recovered"),
    )


def map_points(snapshot: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Position, size, colour and hover texts of each place."""
    latitude, longitude = (F.col(c) for c in spec.dim_attrs[-2:])
    return by_size(snapshot, spec).select(
        F.col(spec.key).alias("name"),
        latitude.alias("lat"),
        longitude.alias("lon"),
        F.col("confirmed").alias("size"),
        F.col("active_per_100k").alias("color"),
        fixed_decimals(latitude, 2).alias("lat_label"),
        fixed_decimals(longitude, 2).alias("lon_label"),
        thousands(F.col("confirmed")).alias("size_label"),
        fixed_decimals(F.col("active_per_100k"), 1).alias("color_label"),
    )


def key_detail(
    facts: DataFrame,
    key: str,
    spec: PanelSpec = DEFAULT_SPEC,
    latest: Latest = None,
) -> DataFrame:
    """The formatted card of one key. The key is filtered on the facts, so only
    its own rows are read where the table is laid out for it. ``latest`` may hold
    the key's latest date where there is a cheaper way to it."""
    own = facts.where(F.col(spec.key) == key)
    return detail_card(lookup(snapshot_rows(own, spec, latest), key, spec), spec)


def detail_card(row: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    latitude, longitude = spec.dim_attrs[-2:]
    return row.select(
        spec.key,
        thousands(F.col("confirmed")).alias("total_cases"),
        fixed_decimals(F.col("active_per_100k"), 1).alias("active_per_100k"),
        fixed_decimals(F.col(latitude), 2).alias("latitude"),
        fixed_decimals(F.col(longitude), 2).alias("longitude"),
    )


def global_trend(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    return running_total(sum_by_day(facts, spec), date=spec.date)


def top_keys(snapshot: DataFrame, k: int = TOP_K, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    return top_k(snapshot, k, spec).withColumn("label", thousands(F.col("confirmed")))


def global_active_per_100k(
    snapshot: DataFrame, dim: DataFrame, spec: PanelSpec = DEFAULT_SPEC
) -> DataFrame:
    """Active cases at each key's latest date, per 100,000 people of those keys.

    Places of one key are summed before the population is looked up, so that a
    key's people count once. A key the dimension does not have counts with its
    cases and no people.
    """
    per_key = snapshot.groupBy(spec.key).agg(
        F.sum(active(F.col("confirmed"), F.col("recoveries"))).alias("active")
    )
    people = dim.select(spec.key, spec.population)
    totals = per_key.join(people, spec.key, "left").agg(
        F.coalesce(F.sum("active"), F.lit(0)).cast("bigint").alias("total_active"),
        F.coalesce(F.sum(spec.population), F.lit(0)).cast("bigint").alias("total_population"),
    )
    return totals.withColumn(
        "active_per_100k", F.col("total_active") / population_units(F.col("total_population"))
    )


def emptiness(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table saying whether it is empty; a row of each is read."""
    flags = [
        df.limit(1).agg(F.lit(name).alias("table_name"), (F.count(F.lit(1)) == 0).alias("is_empty"))
        for name, df in tables.items()
    ]
    out = flags[0]
    for flag in flags[1:]:
        out = out.unionAll(flag)
    return out


@contextmanager
def dashboard(
    facts: DataFrame,
    dim: DataFrame,
    folder: str | None = None,
    spec: PanelSpec = DEFAULT_SPEC,
) -> Iterator[dict[str, DataFrame]]:
    """Every table of the page from a single pass over the facts.

    The facts are reduced to one row per (place, day) and settled, and all tables
    are computed from that. The copy lies in ``folder`` or else the session's
    checkpoint folder; without either this fails rather than read the facts once for
    each table. It is removed when the context ends, so use the tables inside.
    """
    with settled(daily_rollup(facts, spec), folder) as rollup:
        yield page_tables(rollup, dim, spec)


def page_tables(
    rollup: DataFrame, dim: DataFrame, spec: PanelSpec = DEFAULT_SPEC
) -> dict[str, DataFrame]:
    """The tables of the page from a daily rollup."""
    summary = global_summary(rollup, spec)
    snapshot = snapshot_from_rollup(rollup, spec)
    daily = sum_by_day(rollup, spec)
    return {
        "summary": summary,
        "headline": headline_kpis(summary),
        "trend": running_total(daily, date=spec.date),
        "snapshot": by_size(snapshot, spec),
        "map": map_points(snapshot, spec),
        "monthly": monthly_totals(rollup, spec),
        "keys": key_list(rollup, spec),
        "top": top_keys(snapshot, spec=spec),
        "timelines": key_timelines(rollup, spec=spec),
        "growth": monthly_growth(sum_by_month(rollup, spec), spec),
        "delta": daily_delta(daily, spec.date),
        "global_rate": global_active_per_100k(snapshot, dim, spec),
    }
