"""Feeds in canonical shape, made from the test tables.

Regions are nations under digit-coded keys, ``(region + 1) * 1000 + nation + 1``; states
are the table's regions; an order is a case, a finished order a death; population is the
number of customers.  Lines shipped by a supplier stand for doses, mobility, intensive
care and hospital counts.  The nations of the first region play the districts of a city
that some feeds publish as a whole, one nation's doses have no known place.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.functions import int_div, round_ratio
from regiopanel.operators.spine import day_span
from regiopanel.plans.levels import City, Options, placed_doses, region_counts, upper_counts
from regiopanel.session import fresh_path, stored
from regiopanel.sinks.tables import Buckets, replace_table

CITY = City(key=1000, lo=1000, hi=2000, name="Whole city", kind="city")
OPTIONS = Options(city=CITY)
UNPLACED_NATION = 24
# Nations without a code of their own: the first is found through postal codes, the
# second is in no postal file either.
REPAIRED_NATION = 23
LOST_NATION = 22
STATUS = {"A": 1, "N": 2, "R": 3}


def region_key() -> Column:
    return ((F.col("n_regionkey") + 1) * 1000 + F.col("n_nationkey") + 1).cast("int")


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _percent(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


class Standins:
    """The feeds of one data folder.

    Dimension joins carry no broadcast hint: Spark broadcasts a side it knows to be
    small and shuffles otherwise, splitting skewed partitions at run time.  ``store``
    names intermediates with several consumers, which are written to the shared folder.
    """

    def __init__(self, spark: SparkSession, folder: str, store: Collection[str] = ()):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._store = frozenset(store)
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def nations(self) -> DataFrame:
        return self.table("nation").select("n_nationkey", "n_name", "n_regionkey", region_key().alias("geo"))

    @cached_property
    def cases(self) -> DataFrame:
        """One row per order: geo, day, cases, deaths."""
        orders = self.table("orders").select("o_custkey", "o_orderdate", "o_orderstatus")
        home = self.table("customer").join(self.nations, F.col("c_nationkey") == F.col("n_nationkey"))
        home = home.select(F.col("c_custkey").alias("o_custkey"), "geo")
        return orders.join(home, "o_custkey").select(
            "geo",
            F.col("o_orderdate").cast("date").alias("day"),
            F.lit(1).cast("bigint").alias("cases"),
            (F.col("o_orderstatus") == "F").cast("bigint").alias("deaths"),
        )

    @cached_property
    def case_days(self) -> DataFrame:
        """Report days alone; their first and last need one column and no join."""
        return self.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, stored first if the query names it as read several times."""
        return stored(df, name) if name in self._store else df

    @cached_property
    def population(self) -> DataFrame:
        counts = self.table("customer").groupBy("c_nationkey").agg(F.count("*").alias("population"))
        return counts.withColumnRenamed("c_nationkey", "n_nationkey")

    @cached_property
    def inhabitants(self) -> DataFrame:
        """geo and population alone."""
        people = F.coalesce("population", F.lit(0).cast("bigint")).alias("population")
        return self.nations.join(self.population, "n_nationkey", "left").select("geo", people)

    @cached_property
    def regions(self) -> DataFrame:
        """geo, population, name, kind, state, state_name, nuts, vintage."""
        states = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        known = ~F.col("n_nationkey").isin(REPAIRED_NATION, LOST_NATION) & (F.col("n_regionkey") > 0)
        regions = (
            self.nations.join(states, "n_regionkey")
            .join(self.population, "n_nationkey", "left")
            .select(
                "geo",
                F.coalesce("population", F.lit(0).cast("bigint")).alias("population"),
                F.col("n_name").alias("name"),
                F.lit("nation").alias("kind"),
                (F.col("n_regionkey") + 1).cast("int").alias("state"),
                F.col("r_name").alias("state_name"),
                F.when(known, self._nuts()).alias("nuts"),
                F.lit("2001-12-31").cast("date").alias("vintage"),
            )
        )
        return self.kept(regions, "regions")

    @staticmethod
    def _nuts() -> Column:
        """Regional code; the whole city has one."""
        return F.when(F.col("n_regionkey") == 0, "N00").otherwise(F.format_string("N%02d", "n_nationkey"))

    @cached_property
    def _places(self) -> DataFrame:
        """Nation with the key and code its counts are published under: the city as a whole."""
        key = F.when(F.col("n_regionkey") == 0, CITY.key).otherwise(F.col("geo")).cast("int")
        return self.nations.select("n_nationkey", key.alias("geo"), self._nuts().alias("nuts"))

    @cached_property
    def _suppliers(self) -> DataFrame:
        suppliers = self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
        return suppliers.join(self._places, "n_nationkey")

    @cached_property
    def lines(self) -> DataFrame:
        """Shipped lines with their supplier's nation."""
        lines = self.table("lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
        )
        return lines.join(suppliers, "l_suppkey")

    @cached_property
    def line_days(self) -> DataFrame:
        """Counts per place, day and status: the one pass over the lines the feeds share.

        The place's key and code depend on the nation, so they are looked up after the
        aggregation, on its few rows.
        """
        counts = self.lines.groupBy("n_nationkey", "day", "l_returnflag").agg(
            F.count("*").alias("n"),
            _count(F.col("l_linestatus") == "O").alias("n_open"),
            _count((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 25)).alias("n_heavy"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(_percent("l_discount") - 5).alias("discount"),
            F.sum(_percent("l_tax")).alias("tax"),
        )
        return self.kept(counts.join(self._places, "n_nationkey"), "line_days")

    @cached_property
    def placed(self) -> DataFrame:
        return self.kept(placed_doses(self.doses, OPTIONS), "placed")

    @cached_property
    def counts(self) -> DataFrame:
        """Dense region panel of cases, deaths and doses; where it is stored, windows by region need no exchange."""
        panel = region_counts(self.cases, self.placed, self.regions, OPTIONS, days_of=self.span)
        if "counts" not in self._store:
            return panel
        buckets = Buckets(int(self.spark.conf.get("spark.sql.shuffle.partitions")), ("geo",), ("day",))
        return replace_table(panel, fresh_path(self.spark, "counts"), buckets)

    @cached_property
    def span(self) -> DataFrame:
        return self.kept(day_span(self.case_days), "span")

    @cached_property
    def upper(self) -> DataFrame:
        """Sums of the region panel by state and for the country."""
        return self.kept(upper_counts(self.counts, self.doses, self.regions, OPTIONS, days_of=self.span), "upper")

    @cached_property
    def doses(self) -> DataFrame:
        """day, place (text, ``u`` if unknown), status, doses."""
        place = F.when(F.col("n_nationkey") == UNPLACED_NATION, "u").otherwise(F.col("geo").cast("string"))
        status = F.coalesce(*[F.when(F.col("l_returnflag") == k, v) for k, v in STATUS.items()])
        return self.line_days.select("day", place.alias("place"), status.alias("status"), F.col("n").alias("doses"))

    @cached_property
    def by_level(self) -> DataFrame:
        """Sums of the lines by place, state and country, from one pass: what mobility and intensive care need."""
        free = F.col("l_returnflag") == "A"
        keyed = self.line_days.withColumn("state", int_div("geo", 1000).cast("int"))
        geo, nuts, state, day = (F.col(c) for c in ("geo", "nuts", "state", "day"))
        sums = keyed.groupingSets([[geo, nuts, state, day], [state, day], [day]], geo, nuts, state, day).agg(
            F.grouping(geo).alias("_no_geo"),
            F.grouping(state).alias("_no_state"),
            *[F.sum(c).alias(c) for c in ("n", "quantity", "discount", "tax")],
            F.sum("n_open").alias("icu_cases"),
            F.sum("n_heavy").alias("icu_ventilated"),
            F.sum(F.when(free, F.col("n")).otherwise(0)).alias("beds_free"),
            F.sum(F.when(free, 0).otherwise(F.col("n"))).alias("beds_occupied"),
        )
        level = F.when(F.col("_no_geo") == 0, "region").when(F.col("_no_state") == 0, "state").otherwise("country")
        return self.kept(sums.withColumn("level", level).drop("_no_geo", "_no_state"), "by_level")

    def _mobility(self, level: str, *keys: str) -> DataFrame:
        return self.by_level.filter(F.col("level") == level).select(
            *keys,
            "day",
            round_ratio("discount", "n", 4).alias("mobility_change"),
            round_ratio("quantity", "n", 4).alias("mobility_change_7day_average"),
            round_ratio("tax", "n", 4).alias("mobility_change_weekly"),
        )

    @cached_property
    def mobility_region(self) -> DataFrame:
        return self._mobility("region", "nuts")

    @cached_property
    def mobility_state(self) -> DataFrame:
        names = self.regions.select("state", "state_name").distinct()
        return self._mobility("state", "state").join(names, "state").drop("state")

    @cached_property
    def mobility_country(self) -> DataFrame:
        return self._mobility("country")

    @cached_property
    def icu(self) -> DataFrame:
        """geo, day, icu_cases, icu_ventilated, beds_free, beds_occupied, state."""
        places = self.by_level.filter("level = 'region'")
        return places.select("geo", "day", "icu_cases", "icu_ventilated", "beds_free", "beds_occupied", "state")

    @cached_property
    def hospital(self) -> DataFrame:
        """level_id (0 is the country), day, age_group, hospital_cases."""
        rows = self.line_days.select(
            F.explode(F.array(int_div("geo", 1000).cast("int"), F.lit(0))).alias("level_id"),
            "day",
            F.col("l_returnflag").alias("age_group"),
            "quantity",
        )
        return rows.groupBy("level_id", "day", "age_group").agg(F.sum("quantity").alias("hospital_cases"))

    @cached_property
    def postal_nuts(self) -> DataFrame:
        """nuts3 and postal code; one supplier is one postal code."""
        listed = self._suppliers.filter(F.col("n_nationkey") != LOST_NATION)
        return listed.select(F.col("nuts").alias("nuts3"), F.col("s_suppkey").alias("code"))

    @cached_property
    def postal_keys(self) -> DataFrame:
        """Postal code and community key, whose leading digits are the region key."""
        community = F.col("geo").cast("bigint") * 1000 + F.col("s_suppkey") % 1000
        return self._suppliers.select(F.col("s_suppkey").alias("plz"), community.alias("ags"))
