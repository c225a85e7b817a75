"""The raw inputs, derived from the driver's tables.

Keys keep their 64-bit type and every view reads its tables whole. Gaps are
there by nature: oil has the dates of orders, not of shipments, and no quote on
the first of a month; checkouts have the dates of orders too; and the holidays
of a month fall on its first day.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import city_key
from shelfcast.operators import signals, star
from shelfcast.operators.filters import perishable, without_returns
from shelfcast.plans.features import FeatureTables, feature_tables
from shelfcast.session import bounded_tasks, stage_all
from shelfcast.testkit.tables import TABLES

PERISHABLE_TYPES = ("SMALL", "MEDIUM")


class Inputs:
    """Raw inputs and the tables built from them, each built at most once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        bounded_tasks(spark, self.table("lineitem").count())

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    # Raw inputs.

    @cached_property
    def items(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("item_nbr"),
            F.col("p_type").alias("family"),
            F.col("p_size").alias("class"),
            F.col("p_type").isin(*PERISHABLE_TYPES).cast("int").alias("perishable"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        city = F.concat(F.lit("  "), F.replace("n_name", F.lit("_"), F.lit("%20")), F.lit(" "))
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
            .join(self.table("region"), F.col("r_regionkey") == F.col("n_regionkey"))
            .select(
                F.col("s_suppkey").alias("store_nbr"),
                city.alias("city"),
                F.col("r_name").alias("state"),
                F.col("r_name").alias("type"),
                F.col("s_nationkey").alias("cluster"),
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        returned, discount = F.col("l_returnflag") == "R", F.col("l_discount")
        return self.table("lineitem").select(
            F.to_date("l_shipdate").alias("date"),
            F.col("l_suppkey").alias("store_nbr"),
            F.col("l_partkey").alias("item_nbr"),
            F.when(returned, -F.col("l_quantity"))
            .otherwise(F.col("l_quantity"))
            .alias("unit_sales"),
            F.when(discount >= 0.05, "True").when(discount != 0, "False").alias("onpromotion"),
        )

    @cached_property
    def oil(self) -> DataFrame:
        quoted = F.when(F.dayofmonth("date") != 1, F.col("price"))
        return (
            self.table("orders")
            .select(F.to_date("o_orderdate").alias("date"), "o_totalprice")
            .groupBy("date")
            .agg(F.max("o_totalprice").alias("price"))
            .select("date", quoted.alias("dcoilwtico"))
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy(F.to_date("o_orderdate").alias("date"), F.col("l_suppkey").alias("store_nbr"))
            .agg(F.countDistinct("l_orderkey").cast("int").alias("transactions"))
        )

    @cached_property
    def _orders_by_nation(self) -> DataFrame:
        city = F.replace("n_name", F.lit("_"), F.lit("%20"))
        nations = self.table("nation").withColumn("city_norm", city_key(city))
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("c_custkey") == F.col("o_custkey"))
            .join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
        )

    @cached_property
    def holidays(self) -> DataFrame:
        return self._orders_by_nation.select(
            F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"),
            F.col("o_orderstatus").alias("type"),
            F.col("c_mktsegment").alias("locale"),
            F.col("n_name").alias("locale_name"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """Weather of the sales years, for joins."""
        return self._orders_by_nation.select(
            F.to_date("o_orderdate").alias("date"),
            "city_norm",
            (F.col("o_custkey") % 40).cast("double").alias("temp_c"),
            (F.col("o_orderkey") % 7).cast("double").alias("precip_mm"),
            (F.col("o_orderkey") % 3).cast("double").alias("rain_mm"),
            (F.col("o_custkey") % 100).cast("double").alias("rh_pct"),
            (F.col("o_custkey") % 45).cast("double").alias("apparent_c"),
        )

    @cached_property
    def weather_hourly(self) -> DataFrame:
        """Weather readings of one month, for the files and the rollup."""
        return self.table("events").select(
            "ts",
            F.concat(F.lit("Port%20"), "event_type").alias("city"),
            F.col("value").alias("temp_c"),
            (F.col("event_id") % 7).cast("double").alias("precip_mm"),
            (F.col("event_id") % 3).cast("double").alias("rain_mm"),
            (F.col("user_id") % 100).cast("double").alias("rh_pct"),
            F.col("value").alias("apparent_c"),
        )

    # Tables built from them.

    @cached_property
    def dim_item(self) -> DataFrame:
        return star.item_dimension(self.items)

    @cached_property
    def dim_store(self) -> DataFrame:
        return star.store_dimension(self.stores)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return star.sales_fact(self.sales, self.items)

    @cached_property
    def features(self) -> FeatureTables:
        return feature_tables(
            self.oil, self.transactions, self.holidays, signals.weather_daily(self.weather)
        )

    def stored(self, *names: str) -> tuple[dict[str, DataFrame], FeatureTables]:
        """The named star tables and all feature tables, stored side by side."""
        features = self.features.tables()
        stored = stage_all({**{name: getattr(self, name) for name in names}, **features})
        return (
            {name: stored[name] for name in names},
            FeatureTables(**{name: stored[name] for name in features}),
        )

    @cached_property
    def series(self) -> DataFrame:
        """Sales per date, store and family, the family being the item sold."""
        families = perishable(self.items).select("item_nbr", "family")
        sold = (
            without_returns(self.sales)
            .join(families, "item_nbr")
            .withColumnRenamed("store_nbr", "store_id")
            .withColumn("onpromotion", F.col("onpromotion").try_cast("boolean"))
        )
        daily = star.by_day(sold, "store_id", "family")
        return daily.withColumn("item_id", F.col("family"))

    @cached_property
    def fractional_series(self) -> DataFrame:
        """The series with sales in fractions, as goods sold by weight have."""
        share = F.dayofmonth("date") / 31 + F.pmod("store_id", F.lit(7)) / 7
        return self.series.withColumn("unit_sales", F.col("unit_sales") * share)

    @cached_property
    def rollup_hourly(self) -> DataFrame:
        """Hourly readings with date and city key."""
        return self.weather_hourly.withColumns(
            {"date": F.to_date("ts"), "city_norm": city_key(F.col("city"))}
        )
