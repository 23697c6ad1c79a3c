"""Reporting panels over order-and-shipment tables.

The domain inputs are not public, so the checks and the benchmark run on
panels reduced from star-schema facts.  Facts are joined only on what they
need, then reduced to one row per nation and day by an aggregate that combines
before its shuffle; from there on every table is bounded by nations x days.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bundle import Bundle
from ..operators.merge import in_key_set, lookup, merge_panels
from .landed import Dimensions

PEOPLE_PER_CUSTOMER = 1000

# Quantity thresholds that stand for ages.
AGES = {"GTE5": 5, "GTE12": 12, "GTE18": 18, "GTE65": 40}


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def _sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


class TpchPanels:
    """Lazy panels and dimensions over one directory of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- dimensions ---------------------------------------------------------

    @cached_property
    def nations(self) -> DataFrame:
        joined = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return joined.select(
            F.col("n_nationkey").alias("nation"),
            F.col("n_name").alias("Jurisdiction"),
            F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("State"),
            F.col("r_name").alias("Region"),
            F.col("n_name").alias("GeoID"),
        )

    @cached_property
    def jurisdictions(self) -> DataFrame:
        """The upstream place table: places with their population."""
        people = (
            self.table("customer")
            .groupBy(F.col("c_nationkey").alias("nation"))
            .agg((F.count("*") * PEOPLE_PER_CUSTOMER).alias("Population"))
        )
        return lookup(self.nations, people, "nation").drop("nation")

    @cached_property
    def population(self) -> DataFrame:
        return self.jurisdictions.select("GeoID", "Population")

    @cached_property
    def key_sets(self) -> DataFrame:
        """``base`` leaves one region out; ``rollup`` is four places."""
        sets = F.array(
            F.when(F.col("Region") != "MIDDLE EAST", F.lit("base")),
            F.when(F.col("nation") < 4, F.lit("rollup")),
        )
        return self.nations.select(F.explode(sets).alias("set_name"), "GeoID").where(
            F.col("set_name").isNotNull()
        )

    @cached_property
    def pretty(self) -> DataFrame:
        even = F.col("nation") % 2 == 0
        return self.nations.select(
            F.when(even, F.lit("A")).otherwise(F.lit("B")).alias("Site"),
            "GeoID",
            F.initcap(F.replace("GeoID", F.lit("_"), F.lit(" "))).alias("NiceName"),
            F.col("nation").alias("DisplayOrder"),
            F.col("Region").alias("NiceUpperLevel"),
            F.when(even, F.lit("Not Reported")).alias("ICUBedsDisclaimer"),
            F.lit(None).cast("string").alias("SourceLocation"),
        )

    @cached_property
    def dimensions(self) -> Dimensions:
        return Dimensions(self.population, self.key_sets, self.pretty)

    # -- facts --------------------------------------------------------------

    @cached_property
    def _orders_by_nation(self) -> DataFrame:
        orders = self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_orderpriority",
            F.to_date("o_orderdate").alias("Date"),
        )
        customers = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")
        )
        return orders.join(customers, "o_custkey")

    @cached_property
    def _lines_by_nation(self) -> DataFrame:
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"),
            F.to_date("l_shipdate").alias("Date"),
            "l_quantity",
            "l_returnflag",
            "l_linestatus",
        )
        return lines.join(self._orders_by_nation.select("o_orderkey", "nation"), "o_orderkey")

    def _named(self, daily: DataFrame) -> DataFrame:
        """Daily rows with the identity columns of their nation in front."""
        measures = [c for c in daily.columns if c not in ("nation", "Date")]
        return daily.join(self.nations, "nation").select(
            "Jurisdiction", "State", "Region", "GeoID", "Date", *measures
        )

    @cached_property
    def cdt(self) -> DataFrame:
        """Orders by day: ordered (tests), finished (cases), urgent (deaths)."""
        daily = self._orders_by_nation.groupBy("nation", "Date").agg(
            _count_if(F.col("o_orderstatus") == "F").alias("CasesNew"),
            _count_if(F.col("o_orderpriority") == "1-URGENT").alias("DeathsNew"),
            F.count("*").alias("TestsNew"),
        )
        so_far = _running("GeoID")
        named = self._named(daily).select(
            "Jurisdiction",
            "State",
            "Region",
            "GeoID",
            "Date",
            *[
                column
                for m in ("Cases", "Deaths", "Tests")
                for column in (
                    F.col(f"{m}New"),
                    F.sum(f"{m}New").over(so_far).alias(f"{m}Total"),
                )
            ],
        )
        return lookup(named, self.population)

    @cached_property
    def cdt_newly_reported(self) -> DataFrame:
        """Pending orders by day, never revised."""
        daily = (
            self._orders_by_nation.where(F.col("o_orderstatus") == "P")
            .groupBy("nation", "Date")
            .agg(
                F.count("*").alias("TestsNew"),
                _count_if(F.col("o_orderpriority") == "1-URGENT").alias("DeathsNew"),
                _count_if(F.col("o_orderpriority") == "2-HIGH").alias("CasesNew"),
            )
        )
        return self._named(daily)

    @cached_property
    def hosp(self) -> DataFrame:
        """Shipped quantities by supplier nation and day.

        Lines are read once.  The first line that a supplier has on a day is
        marked after one shuffle by both, which also spreads a busy supplier
        over its days; counting marks counts suppliers.  So sums are kept by
        nation and day alone, and no task holds sums for each supplier and day.
        """
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("nation")
        )
        flag = F.col("l_returnflag")
        lines = self.table("lineitem").select(
            F.col("l_suppkey").alias("supplier"),
            F.to_date("l_shipdate").alias("Date"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.when(flag == "R", 1).when(flag == "A", 2).when(flag == "N", 3).alias("flag"),
            (F.col("l_linestatus") == "F").alias("filled"),
        ).where(F.col("supplier").isNotNull())
        of_day = Window.partitionBy("supplier", "Date").orderBy("Date")
        marked = lines.withColumn("first", F.row_number().over(of_day) == 1)
        quantity, filled = F.col("quantity"), F.col("filled")
        returned, accepted, neither = (F.col("flag") == code for code in (1, 2, 3))
        n = F.count("*")
        measures = {
            "BedsTotal": n * 50,
            "BedsUsed": F.sum(quantity),
            "BedsAvailable": n * 25,
            "BedsICUTotal": n * 20,
            "BedsICUUsed": _sum_if(accepted & filled, quantity),
            "BedsICUAvailable": _count_if(accepted) * 10,
            "BedsInpatientTotal": n * 40,
            "CovidTotal": F.coalesce(_sum_if(returned, quantity), F.lit(0)),
            "CovidNew24HConfirmed": _sum_if(returned & filled, quantity),
            "CovidNew24HSuspected": _sum_if(returned & ~filled, quantity),
            "CovidICUTotal": _sum_if(accepted & ~filled, quantity),
            "CovidICUConfirmed": _count_if(returned & filled),
            "CovidICUSuspected": _count_if(returned & ~filled),
            "CovidConfirmedAdult": _count_if(returned),
            "CovidConfirmedPediatric": _count_if(neither & filled),
            "VentilatorsTotal": n * 9,
            "VentilatorsUsed": _sum_if(neither & filled, quantity),
            "VentilatorsAvailable": _count_if(neither) * 5,
            "CovidVentilatorsUsed": _sum_if(neither & ~filled, quantity),
        }
        daily = (
            marked.join(suppliers, "supplier")
            .groupBy("nation", "Date")
            .agg(
                _count_if(F.col("first")).alias("HospitalsReporting"),
                *[c.alias(name) for name, c in measures.items()],
            )
        )
        places = suppliers.groupBy("nation").agg(F.count("*").alias("HospitalsTotal"))
        return self._named(
            lookup(daily, places, "nation").select(
                "nation", "Date", "HospitalsReporting", "HospitalsTotal", *measures
            )
        )

    @cached_property
    def vacc(self) -> DataFrame:
        """Running totals of lines, filled lines, and filled returned lines."""
        filled = F.col("l_linestatus") == "F"
        daily = self._lines_by_nation.groupBy("nation", "Date").agg(
            F.count("*").alias("DosesAdministered_Total"),
            _count_if(filled).alias("RegimenInitiated_Count"),
            _count_if(filled & (F.col("l_returnflag") == "R")).alias("RegimenCompleted_Count"),
        )
        return lookup(self._run_up(self._named(daily)), self.population)

    @cached_property
    def vacc_cdc(self) -> DataFrame:
        """Running counts by age threshold, with quantity as age."""
        filled = F.col("l_linestatus") == "F"
        returned = F.col("l_returnflag") == "R"
        counted = {
            "RegimenCompleted_Total": filled & returned,
            "RegimenInitiated_Total": filled,
        }
        daily = {name: _count_if(condition) for name, condition in counted.items()}
        for age, at_least in AGES.items():
            old = F.col("l_quantity") >= at_least
            for name, condition in counted.items():
                daily[f"{name}{age}"] = _count_if(condition & old)
            if age != "GTE5":
                daily[f"Boosted_Total{age}"] = _count_if(returned & ~filled & old)
            daily[f"Population{age}"] = _count_if(old)
        named = self._named(
            self._lines_by_nation.groupBy("nation", "Date").agg(
                *[c.alias(n) for n, c in daily.items()]
            )
        )
        whole = Window.partitionBy("GeoID")
        people = {n: F.sum(n).over(whole) for n in daily if n.startswith("Population")}
        return self._run_up(named.withColumns(people), skip=tuple(people))

    @staticmethod
    def _run_up(daily: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
        ids = ("Jurisdiction", "State", "Region", "GeoID", "Date")
        so_far = _running("GeoID")
        return daily.select(
            *[
                F.col(c) if c in (*ids, *skip) else F.sum(c).over(so_far).alias(c)
                for c in daily.columns
            ]
        )

    # -- derived ------------------------------------------------------------

    @cached_property
    def merged(self) -> DataFrame:
        return merge_panels(self.cdt, self.hosp)

    @cached_property
    def region_dense(self) -> DataFrame:
        """Case panel per region with a row for every day of the period."""
        daily = (
            self.cdt.groupBy("Region", "Date")
            .agg(*[F.sum(f"{m}New").alias(f"{m}New") for m in ("Cases", "Deaths", "Tests")])
        )
        people = (
            self.jurisdictions.groupBy("Region").agg(F.sum("Population").alias("Population"))
        )
        span = self.table("orders").agg(
            F.min(F.to_date("o_orderdate")).alias("first"),
            F.max(F.to_date("o_orderdate")).alias("last"),
        )
        calendar = people.select(
            "Region",
            "Population",
            F.explode(
                F.sequence(span.select("first").scalar(), span.select("last").scalar())
            ).alias("Date"),
        )
        so_far = _running("GeoID")
        filled = calendar.join(daily, ["Region", "Date"], "left").select(
            F.col("Region").alias("Jurisdiction"),
            F.lit(None).cast("string").alias("State"),
            F.col("Region"),
            F.col("Region").alias("GeoID"),
            "Date",
            "Population",
            *[
                F.coalesce(f"{m}New", F.lit(0)).alias(f"{m}New")
                for m in ("Cases", "Deaths", "Tests")
            ],
        )
        return filled.withColumns(
            {
                f"{m}Total": F.sum(f"{m}New").over(so_far)
                for m in ("Cases", "Deaths", "Tests")
            }
        )

    @cached_property
    def events(self) -> DataFrame:
        """Raw events with their day: many rows per key and day."""
        return self.table("events").select(
            F.col("event_type").alias("GeoID"),
            F.to_date("ts").alias("Date"),
            "event_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("Clicks"),
        )

    @cached_property
    def inputs(self) -> Bundle:
        """The five inputs of a base bundle, case and hospital data cut to ``base``."""

        def base(panel: DataFrame) -> DataFrame:
            return in_key_set(panel, self.key_sets, "base")

        return Bundle(
            {
                "cdtData": lambda: base(self.cdt),
                "cdtNRData": lambda: base(self.cdt_newly_reported),
                "hospData": lambda: base(self.hosp),
                "vaccData": lambda: self.vacc,
                "vaccCDCData": lambda: self.vacc_cdc,
            }
        )


def _running(key: str):
    return Window.partitionBy(key).orderBy("Date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
