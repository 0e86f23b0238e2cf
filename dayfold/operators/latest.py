"""The latest date of each key, and the rows on it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayfold.functions.dates import month_start
from dayfold.schema import DEFAULT_SPEC, PanelSpec

# Keys whose latest dates are brought to the driver.
KNOWN_KEYS = 10_000


def latest_date_by_key(facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    return facts.groupBy(spec.key).agg(F.max(spec.date).alias("latest_date"))


@dataclass(frozen=True)
class KnownLatest:
    """The latest dates of no more than ``KNOWN_KEYS`` keys, computed once.

    Dates are literals in the queries that follow, so a scan skips by them, and none
    of these reads the facts' dates a second time.
    """

    spark: SparkSession
    rows: pa.Table

    @cached_property
    def table(self) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(self.rows))

    @cached_property
    def days(self) -> list[date]:
        return sorted(pc.unique(self.rows["latest_date"].drop_null()).to_pylist())

    def of(self, key: str) -> KnownLatest:
        return KnownLatest(self.spark, self.rows.filter(pc.equal(self.rows[0], key)))


def known_latest(latest: DataFrame, most: int = KNOWN_KEYS) -> KnownLatest | DataFrame:
    """``latest`` worked out; as it is where it has more rows than ``most``."""
    rows = latest.limit(most + 1).toArrow()
    return KnownLatest(latest.sparkSession, rows) if len(rows) <= most else latest


Latest = DataFrame | KnownLatest | None


def recent_rows(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    """Facts on a day that is some key's latest.

    A query about latest dates may start from here. The days come from a pass over
    key and date alone; there are no more of them than days. The earliest bounds the
    scan, and the set is applied below any join the facts are made of, so that a
    key which ended long ago adds the rows of its last day and no more. In a table
    split by month, the other months' folders are not opened.
    ``latest``, here and below, holds one ``latest_date`` for each key, where the
    caller has a cheaper way to it or knows it already.
    """
    keyed = facts.where(F.col(spec.key).isNotNull())
    stored = spec.scan_date or spec.date
    kind = facts.schema[stored].dataType
    if isinstance(latest, KnownLatest):
        if not latest.days:
            return keyed.where(F.lit(False))
        recent = keyed.where(F.col(stored) >= F.lit(latest.days[0]).cast(kind))
        if spec.month:
            months = sorted({day.replace(day=1) for day in latest.days})
            recent = recent.where(F.col(spec.month).isin(months))
        return recent.where(F.col(spec.date).isin(latest.days))
    latest = latest_date_by_key(keyed, spec) if latest is None else latest
    # Cast inside the subquery: a cast of the stored column would not reach the scan.
    recent = keyed.where(F.col(stored) >= latest.agg(F.min("latest_date").cast(kind)).scalar())
    if spec.month:
        months = latest.agg(F.collect_set(month_start(F.col("latest_date")))).scalar()
        recent = recent.where(F.array_contains(months, F.col(spec.month)))
    days = latest.agg(F.collect_set("latest_date")).scalar()
    return recent.where(F.array_contains(days, F.col(spec.date)))


def latest_rows(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    """All rows on their key's latest date, ties included; NULL keys drop out.

    Rows are matched, not gathered: a hot key's tied rows stay spread over tasks.
    Only recent rows are shuffled for the match, and none where ``latest`` is known or
    comes marked for broadcast by a caller who knows its size.
    """
    latest = latest_date_by_key(facts, spec) if latest is None else latest
    on_latest = (F.col(f"f.{spec.key}") == F.col(f"l.{spec.key}")) & (
        F.col(f"f.{spec.date}") == F.col("l.latest_date")
    )
    recent = recent_rows(facts, spec, latest)
    table = latest.table if isinstance(latest, KnownLatest) else latest
    return recent.alias("f").join(table.alias("l"), on_latest, "left_semi")


def last_row_per_key(
    facts: DataFrame, spec: PanelSpec = DEFAULT_SPEC, latest: Latest = None
) -> DataFrame:
    """One row per key: the last by date, then by the tiebreak columns.

    Only rows on their key's latest date are ranked, and Spark's window group limit
    leaves one candidate per key and task before the shuffle, for a hot key too.
    """
    identity = spec.tiebreak or tuple(c for c in facts.columns if c not in (spec.key, spec.date))
    newest_first = Window.partitionBy(spec.key).orderBy(
        F.desc(spec.date), *[F.desc(c) for c in identity]
    )
    return (
        latest_rows(facts, spec, latest)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
