"""Top-k and single-row lookup on a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.schema import DEFAULT_SPEC, PanelSpec

TOP_K = 10


def top_k(snapshot: DataFrame, k: int = TOP_K, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The ``k`` largest by confirmed; the place settles ties at the cut.

    Plans as TakeOrderedAndProject: k rows per task, no global sort.
    """
    return (
        snapshot.orderBy(F.desc("confirmed"), *spec.place)
        .limit(k)
        .select(spec.key, "confirmed", "active_per_100k")
    )


def lookup(snapshot: DataFrame, key: str, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The first snapshot row of one key, in the snapshot's own order."""
    return (
        snapshot.where(F.col(spec.key) == key)
        .orderBy(F.desc("confirmed"), *spec.place)
        .limit(1)
    )
