"""What the sales say about forecasts that need no fitting, and summaries that merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import backtest, sketches, smoothing, windows
from shelfcast.plans.ingest import StarSchema
from shelfcast.plans.training import perishable_series
from shelfcast.session import stage
from shelfcast.sinks import Release, read_table

TABLES = ("backtest_errors", "smoothed_demand", "monthly_sketches")


def run(
    spark: SparkSession, tables: StarSchema, out: str, daily: bool = False
) -> dict[str, DataFrame]:
    """Store errors from rolling origins, smoothed demand per series, and monthly sketches.

    Without dated sales there are no origins, and all tables are empty.
    """
    series = stage(perishable_series(tables.fact_sales, tables.dim_item, daily), "series")
    last = series.agg(F.max("date")).first()[0]
    known = backtest.origins(last) if last else []
    history = windows.with_history(series, verify=daily).withColumnRenamed("unit_sales", "y")
    # only rows of a horizon are judged, but their history goes further back
    made = backtest.forecasts_from(stage(history, "history"), known)
    with Release(spark, out) as release:
        release.write(backtest.errors_by_origin(made).coalesce(1), "backtest_errors")
        release.write(smoothing.smoothed_demand(series), "smoothed_demand")
        release.write(sketches.monthly_sketches(series), "monthly_sketches")
        release.publish(*TABLES)
    return {name: read_table(spark, f"{out}/{name}") for name in TABLES}
