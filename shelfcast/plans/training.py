"""Sales joined with every signal: enriched sales, model base, training table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import calendar_columns
from shelfcast.operators import joins, signals, star, windows
from shelfcast.operators.filters import warmed_up
from shelfcast.plans.features import FeatureTables
from shelfcast.plans.ingest import StarSchema
from shelfcast.sinks import Release, read_table
from shelfcast.sources import Database


def _signals(dim_store: DataFrame, features: FeatureTables, holidays: DataFrame) -> dict:
    return {
        "store_cities": star.store_cities(dim_store),
        "oil": features.oil,
        "transactions": features.transactions,
        "holidays": holidays,
        "weather": features.weather,
    }


def enriched_sales(
    fact: DataFrame, dim_store: DataFrame, features: FeatureTables
) -> DataFrame:
    """Sales with filled signals, 16 columns."""
    parts = _signals(dim_store, features, signals.holiday_dates(features.holidays))
    return joins.fill_signals(joins.with_signals(fact, **parts)).select(schemas.ENRICHED_SALES)


def model_base(tables: StarSchema, features: FeatureTables) -> DataFrame:
    """Sales of perishable items with item, holiday and signal columns, unfilled."""
    fact = joins.with_item(tables.fact_sales, tables.dim_item)
    parts = _signals(tables.dim_store, features, features.holidays)
    return joins.with_signals(fact, **parts).select(schemas.MODEL_BASE)


def perishable_series(
    fact: DataFrame, dim_item: DataFrame, daily: bool = False
) -> DataFrame:
    """Sales of perishable items with their family, one row per series and date.

    ``daily`` says that the fact has one row per series and date already, which
    saves the shuffle that makes sure of it; the history should then verify it.
    """
    items = dim_item.select("item_id", "family", "perishable")
    sales = joins.with_item(fact, items).drop("perishable")
    return sales if daily else star.by_day(sales, "store_id", "item_id", "family")


def training_table(
    series: DataFrame,
    dim_store: DataFrame,
    features: FeatureTables,
    partitions: int | None = None,
    verify: bool = False,
) -> DataFrame:
    """Series with history, signals and calendar, 30 columns.

    ``verify`` fails on a series that repeats a date.

    The history needs only the sales, so it comes first: its shuffle and sort
    carry six narrow columns instead of the joined row, and the signals are
    looked up only for the rows that outlive the warm-up. With signals unique
    by key, as ``quality.assert_unique`` checks, the result is that of joining
    first.
    """
    history = warmed_up(windows.with_history(series, partitions=partitions, verify=verify))
    return finished(history, dim_store, features)


def finished(history: DataFrame, dim_store: DataFrame, features: FeatureTables) -> DataFrame:
    """Rows with their history as training rows: signals looked up, calendar added."""
    flagged = features.holidays.select("date", F.lit(1).alias("is_holiday"))
    parts = _signals(dim_store, features, flagged)
    joined = joins.fill_signals(joins.with_signals(history, **parts))
    return (
        joined.withColumns(calendar_columns(F.col("date")))
        .withColumnRenamed("unit_sales", "y")
        .select(schemas.MODEL_TRAIN)
    )


def run_enrich(
    spark: SparkSession,
    tables: StarSchema,
    features: FeatureTables,
    out: str,
    database: Database | None = None,
) -> DataFrame:
    with Release(spark, out) as release:
        table = enriched_sales(tables.fact_sales, tables.dim_store, features)
        release.write(table, "fact_sales_enriched")
        release.publish("fact_sales_enriched")
    stored = read_table(spark, f"{out}/fact_sales_enriched")
    if database:
        database.overwrite(stored, "fact_sales_enriched", transactions=False)
    return stored


def run_model_base(
    spark: SparkSession, tables: StarSchema, features: FeatureTables, out: str
) -> DataFrame:
    with Release(spark, out) as release:
        release.write(model_base(tables, features), "model_base")
        release.publish("model_base")
    return read_table(spark, f"{out}/model_base")


def run_training(
    spark: SparkSession,
    tables: StarSchema,
    features: FeatureTables,
    out: str,
    daily: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Write the training table by year and month; both come last on read-back.

    It takes the place of the stored one when it is complete.
    """
    series = perishable_series(tables.fact_sales, tables.dim_item, daily)
    table = training_table(series, tables.dim_store, features, partitions, verify=daily)
    with Release(spark, out) as release:
        release.write_by_month(table, "model_train")
        release.publish("model_train")
    return read_table(spark, f"{out}/model_train")
