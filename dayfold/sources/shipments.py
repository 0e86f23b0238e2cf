"""Daily facts from shipped order lines: place is the supplier's nation.

Confirmed is the shipped quantity, Deaths marks a returned line, Recoveries is
the quantity of a finished line, and a nation's population is 10,000 for each
of its customers.

A line whose supplier or nation is unknown has a NULL place: it counts wherever no
key is needed and drops out elsewhere, as any fact without a key. Queries that
need no place therefore start from ``measures`` and do no join at all.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.dates import month_start
from dayfold.functions.measures import per_capita_rate
from dayfold.operators.latest import KNOWN_KEYS, KnownLatest, known_latest, latest_date_by_key
from dayfold.schema import PanelSpec
from dayfold.sources.tables import denormalise, read_typed

PEOPLE_PER_CUSTOMER = 10_000

# Of one row of ``places``, generously.
PLACE_BYTES = 128

SHIPMENT_SPEC = PanelSpec(
    tiebreak=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), scan_date="l_shipdate"
)
SITE_SPEC = PanelSpec(key="Site")

TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def broadcast_bytes(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def stored_bytes(table: DataFrame) -> int:
    """How large a stored table's files are, as the optimizer knows."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Shipments:
    """The tables of one directory as measures, dimensions and facts.

    Each is built once, so queries that combine several share their scans' plans
    and the optimizer can reuse exchanges between them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables: dict[str, DataFrame] = {}
        self.sizes: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        """A table with its declared types, checked against the file's own schema."""
        if name not in self.tables:
            path = f"{self.sf_dir}/{name}.parquet"
            self.tables[name] = read_typed(self.spark, path, TABLES[name])
        return self.tables[name]

    def read_all(self) -> None:
        """Read what places need at once: each schema is a small job of its own."""
        with ThreadPoolExecutor(len(TABLES)) as pool:
            list(pool.map(self.table, TABLES))

    def small(self, name: str) -> bool:
        """Whether a table is within the session's broadcast limit."""
        if name not in self.sizes:
            self.sizes[name] = stored_bytes(self.table(name))
        return self.sizes[name] <= broadcast_bytes(self.spark)

    @cached_property
    def nations(self) -> DataFrame:
        """One row per nation. The left join to a per-nation aggregate is dropped
        by the optimizer wherever Population is not used.

        By estimate the join is as large as the customers. It has the nations' rows
        though, so it is marked for broadcast where their table is small.
        """
        self.read_all()
        customers = (
            self.table("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
        )
        stored = self.table("nation")
        nations = stored.join(customers, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
            "n_nationkey AS ordinal",
            "n_name AS Country",
            "concat('N', lpad(string(n_nationkey), 2, '0')) AS ISO_Alpha",
            "double(n_nationkey) * 5 - 60 AS Latitude",
            "double(n_nationkey) * 14 - 170 AS Longitude",
            f"coalesce(customers, 0) * {PEOPLE_PER_CUSTOMER} AS Population",
        )
        return F.broadcast(nations) if self.small("nation") else nations

    @cached_property
    def sites(self) -> DataFrame:
        """One row per supplier, placed in its nation: a dimension that grows."""
        suppliers = self.table("supplier").selectExpr(
            "s_suppkey", "s_name AS Site", "s_nationkey AS ordinal"
        )
        return suppliers.join(self.nations, "ordinal").selectExpr(
            "s_suppkey AS ordinal", "Site", "ISO_Alpha", "Latitude", "Longitude", "Population"
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        """Supplier to nation."""
        return self.table("supplier").selectExpr(
            "s_suppkey AS l_suppkey", "s_nationkey AS ordinal"
        )

    @cached_property
    def places(self) -> DataFrame:
        """Supplier to place: the nation looked up before any line is.

        Grows with the data. It has the suppliers' rows, so it is marked for broadcast
        while their table is small; beyond, lines join it by shuffle, where AQE splits
        a hot supplier.
        """
        places = denormalise(self.suppliers, self.nations, PanelSpec(key="ordinal"))
        return F.broadcast(places) if self.small("supplier") else places

    def places_in(self, nations: DataFrame) -> DataFrame:
        """The places, of these nations at least.

        Where suppliers are too many to broadcast, their nations' codes, if not very many,
        become a filter of literals on the suppliers. Spark can then build a runtime
        filter from the suppliers left, and lines of others are not shuffled for the join.
        """
        if self.small("supplier"):
            return self.places
        codes = [row[0] for row in nations.select("ordinal").take(KNOWN_KEYS + 1)]
        if len(codes) > KNOWN_KEYS:
            return self.places
        own = self.suppliers.where(F.col("ordinal").isin(codes))
        return denormalise(own, self.nations, PanelSpec(key="ordinal"))

    def places_of(self, key: str) -> DataFrame:
        """The places of one nation. Where the suppliers are too many to broadcast its
        own may be few; they are counted, and then marked."""
        named = F.col("Country") == key
        own = self.places_in(self.nations.where(named)).where(named)
        if self.small("supplier"):
            return own
        own_size = own.count() * PLACE_BYTES
        return F.broadcast(own) if own_size <= broadcast_bytes(self.spark) else own

    @cached_property
    def measures(self) -> DataFrame:
        """Date, measures and row identity of each line; no place, no join."""
        return self.table("lineitem").selectExpr(
            "l_shipdate",
            "date(l_shipdate) AS Date",
            "int(l_quantity) AS Confirmed",
            "if(l_returnflag = 'R', 1, 0) AS Deaths",
            "if(l_linestatus = 'F', int(l_quantity), 0) AS Recoveries",
            *SHIPMENT_SPEC.tiebreak,
        )

    def placed(self, lines: DataFrame) -> DataFrame:
        """Look up each line's place through its supplier."""
        return lines.join(self.places, "l_suppkey", "left").drop("ordinal")

    def rated(self, placed: DataFrame) -> DataFrame:
        rate = per_capita_rate(F.col("Confirmed"), F.col("Recoveries"), F.col("Population"))
        return placed.withColumn("Active_Per_100k", rate)

    @cached_property
    def facts(self) -> DataFrame:
        """The nine fact columns, the population, and the row's identity."""
        return self.rated(self.placed(self.measures))

    def facts_at(self, places: DataFrame) -> DataFrame:
        """The facts of some suppliers' places only."""
        return self.rated(self.measures.join(places, "l_suppkey").drop("ordinal"))

    @cached_property
    def latest_by_nation(self) -> DataFrame:
        """The latest date of each nation, by code.

        Where suppliers are few enough to broadcast, lines look up their nation in the
        task that reads them. Beyond, they are reduced to one row per supplier first, so
        what is joined is no larger than the supplier table, and a supplier with a third
        of all lines is one row per task when it is shuffled.
        """
        if self.small("supplier"):
            lines = self.measures.select("Date", "l_suppkey")
            by_nation = lines.join(F.broadcast(self.suppliers), "l_suppkey")
            return latest_date_by_key(by_nation, PanelSpec(key="ordinal"))
        last_per_supplier = self.measures.groupBy("l_suppkey").agg(F.max("Date").alias("Date"))
        by_supplier = last_per_supplier.join(self.suppliers, "l_suppkey")
        return latest_date_by_key(by_supplier, PanelSpec(key="ordinal"))

    @cached_property
    def latest(self) -> DataFrame:
        """The same by name, which is unique: ``latest_date_by_key`` of the facts. One
        row per nation, marked for broadcast where the nations' table is small."""
        named = self.latest_by_nation.join(self.nations, "ordinal").select("Country", "latest_date")
        return F.broadcast(named) if self.small("nation") else named

    @cached_property
    def known_latest(self) -> KnownLatest | DataFrame:
        """The same worked out, for the queries about the rows on those dates."""
        return known_latest(self.latest)

    @cached_property
    def monthly_facts(self) -> DataFrame:
        """Facts for queries by month or coarser.

        Where suppliers are few enough to broadcast, lines find their place in the
        task that reads them and are summed once, by place. Beyond, they are summed to
        (supplier, month) before suppliers are looked up, so the join carries months of
        suppliers instead of lines, and a supplier with a third of all lines is a few
        rows per task.
        """
        if self.small("supplier") and self.small("nation"):
            return self.placed(self.measures)
        by_supplier = self.measures.groupBy(
            "l_suppkey", month_start(F.col("Date")).alias("Date")
        ).agg(F.sum("Confirmed").alias("Confirmed"))
        return self.placed(by_supplier)

    @cached_property
    def last_date(self) -> Column:
        """The latest date of all, as a scalar."""
        return self.measures.agg(F.max("Date")).scalar()
