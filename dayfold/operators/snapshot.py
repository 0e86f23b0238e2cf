"""One row per place at its latest date, in three forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.operators.latest import Latest, last_row_per_key, latest_rows
from dayfold.schema import DEFAULT_SPEC, PanelSpec


def snapshot_rows(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    """Tied rows summed, the rate averaged; unordered.

    The latest date is that of the key, while a result row is a place: a key
    recorded at two places on that date gives two rows. Only rows on their key's
    latest date are summed, map-side first.
    """
    return _as_snapshot(daily_rollup(latest_rows(facts, spec, latest), spec), spec)


def by_size(snapshot: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Largest first; the place settles equal sizes."""
    return snapshot.orderBy(F.desc("confirmed"), *spec.place)


def region_snapshot(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    return by_size(snapshot_rows(facts, spec, latest), spec)


def region_snapshot_one_row(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    """The last row of each key as it stands, sorted by key."""
    return (
        last_row_per_key(facts, spec, latest)
        .select(
            *spec.place,
            F.col(spec.confirmed).alias("confirmed"),
            F.col(spec.rate).alias("active_per_100k"),
        )
        .orderBy(spec.key)
    )


def daily_rollup(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Facts reduced to one row per (place, day), under the facts' own names.

    Sums of these sums are sums of the facts, so the rollup stands in for the
    fact table in every summing operator. The average rate is carried as a sum
    and a count.
    """
    return facts.groupBy(*spec.place, spec.date).agg(
        F.sum(spec.confirmed).alias(spec.confirmed),
        F.sum(spec.deaths).alias(spec.deaths),
        F.sum(spec.recoveries).alias(spec.recoveries),
        F.sum(spec.rate).alias("rate_sum"),
        F.count(spec.rate).alias("rate_rows"),
    )


def snapshot_from_rollup(rollup: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The ties-summed snapshot from a rollup; unordered, one scan in all.

    Ranked by date alone, so a key's places that share the latest date all have
    rank 1. The window group limit drops older days before the shuffle by key.
    """
    newest_first = Window.partitionBy(spec.key).orderBy(F.desc(spec.date))
    known = F.col(spec.key).isNotNull() & F.col(spec.date).isNotNull()
    last = (
        rollup.where(known)
        .withColumn("_rank", F.rank().over(newest_first))
        .where(F.col("_rank") == 1)
    )
    return _as_snapshot(last, spec)


def _as_snapshot(rollup: DataFrame, spec: PanelSpec) -> DataFrame:
    return rollup.select(
        *spec.place,
        F.col(spec.confirmed).alias("confirmed"),
        F.col(spec.deaths).alias("deaths"),
        F.col(spec.recoveries).alias("recoveries"),
        F.when(F.col("rate_rows") > 0, F.col("rate_sum") / F.col("rate_rows")).alias(
            "active_per_100k"
        ),
    )
