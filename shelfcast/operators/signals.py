"""Outside signals at a daily grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import city_key

_AGGREGATES = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def oil_daily(oil: DataFrame) -> DataFrame:
    """National oil price by date."""
    return oil.select("date", F.col("dcoilwtico").alias("oil_price"))


def transactions_daily(transactions: DataFrame) -> DataFrame:
    """Number of checkouts by date and store."""
    return transactions.select("date", F.col("store_nbr").alias("store_id"), "transactions")


def holiday_dates(holidays: DataFrame) -> DataFrame:
    """Dates with a holiday anywhere, flagged 1; a record without a date gives 0."""
    return (
        holidays.select("date")
        .distinct()
        .withColumn("is_holiday", F.col("date").isNotNull().cast("int"))
    )


def holidays_daily(holidays: DataFrame) -> DataFrame:
    """One holiday per date: the first by type, locale and locale name.

    Repeated records go in a hash aggregation before the shuffle, so the
    ordering step sees each distinct holiday once.
    """
    named = holidays.select(
        "date", F.col("type").alias("holiday_type"), "locale", "locale_name"
    )
    order = Window.partitionBy("date").orderBy("holiday_type", "locale", "locale_name")
    return (
        named.distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def weather_daily(hourly: DataFrame) -> DataFrame:
    """Hourly measures rolled up to date and city."""
    return hourly.groupBy("date", "city_norm").agg(
        *[_AGGREGATES[how](column).alias(name) for name, how, column in schemas.WEATHER_ROLLUP]
    )


def with_date(table: DataFrame) -> DataFrame:
    """A table whose date may be stored as a timestamp or text; other text gives NULL."""
    return table.withColumn("date", F.col("date").try_cast("date"))


def with_city_key(weather: DataFrame) -> DataFrame:
    """Daily weather whose city names may still need normalising."""
    return weather.withColumn("city_norm", city_key(F.col("city_norm")))
