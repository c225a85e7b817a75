"""The sales star schema: two dimensions and a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import city_key
from shelfcast.operators.filters import is_set, perishable, without_returns


def item_dimension(items: DataFrame) -> DataFrame:
    """Perishable items, whole-row distinct."""
    return (
        perishable(items)
        .select(
            F.col("item_nbr").alias("item_id"),
            "family",
            "class",
            is_set(items, "perishable").alias("perishable"),
        )
        .distinct()
    )


def store_dimension(stores: DataFrame) -> DataFrame:
    """Stores, whole-row distinct. An id whose attributes differ keeps each row."""
    return stores.withColumnsRenamed({"store_nbr": "store_id", "type": "store_type"}).select(
        schemas.DIM_STORE
    ).distinct()


def store_cities(dim_store: DataFrame) -> DataFrame:
    """Lookup from a store to the join key of its city."""
    return dim_store.select("store_id", city_key(F.col("city")).alias("city_norm"))


def of_perishables(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Sales of perishable items, through the item keys alone.

    An inner join, as an item listed twice counts twice.
    """
    return sales.join(perishable(items).select("item_nbr"), "item_nbr")


def sales_fact(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Sold quantities of perishable items, one row per sales record with a date.

    Without a date a record belongs to no place in its series.
    """
    return (
        of_perishables(without_returns(sales).where("date IS NOT NULL"), items)
        .withColumnsRenamed({"store_nbr": "store_id", "item_nbr": "item_id"})
        .withColumn("onpromotion", F.col("onpromotion").try_cast("boolean"))
        .select(schemas.FACT_SALES)
    )


def by_day(fact: DataFrame, *series: str) -> DataFrame:
    """One row per series and date: units summed, promoted if any record was.

    Partial sums are taken before the shuffle, so a series that holds a large
    share of the records arrives as one row per task and date. Afterwards no
    series has more rows than the calendar has days, which bounds every window
    over it.
    """
    promoted = [F.max("onpromotion").alias("onpromotion")] if "onpromotion" in fact.columns else []
    return fact.groupBy("date", *(series or ("store_id", "item_id"))).agg(
        F.sum("unit_sales").alias("unit_sales"), *promoted
    )
