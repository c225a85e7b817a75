"""Forecasts of patchy demand: size and spacing of sales smoothed apart (Croston's method)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.windows import ITEM_SERIES

WEIGHT = 0.1


def smoothed_demand(
    series: DataFrame,
    keys: Sequence[str] = ITEM_SERIES,
    measure: str = "unit_sales",
    weight: float = WEIGHT,
) -> DataFrame:
    """Per series: ``demand_size``, ``demand_interval`` in days, and units a day ``forecast``.

    A row is a demand if it sold anything. Size and interval start with the first demand and
    an interval of one day; each later demand moves both by ``weight``. That depends on the
    order of all rows before, which no window frame states: the demands of a series, no more
    than the calendar has days, are put in order and folded up. A series without any demand
    has no forecast; rows without a date or amount are none.
    """
    demand = (F.col(measure) > 0) & ~F.isnan(measure) & F.col("date").isNotNull()
    row = F.struct("date", F.col(measure).cast("double").alias("units"))
    grouped = series.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(demand, row))).alias("demands")
    )

    def moved(old: Column, new: Column) -> Column:
        return old + weight * (new - old)

    def step(held: Column, one: Column) -> Column:
        first = held["date"].isNull()
        days = F.datediff(one["date"], held["date"]).cast("double")
        return F.struct(
            one["date"].alias("date"),
            F.when(first, one["units"]).otherwise(moved(held["size"], one["units"])).alias("size"),
            F.when(first, F.lit(1.0)).otherwise(moved(held["gap"], days)).alias("gap"),
        )

    start = F.struct(
        F.lit(None).cast("date").alias("date"),
        F.lit(None).cast("double").alias("size"),
        F.lit(None).cast("double").alias("gap"),
    )
    folded = grouped.select(*keys, F.aggregate("demands", start, step).alias("state"))
    return folded.select(
        *keys,
        F.col("state.size").alias("demand_size"),
        F.col("state.gap").alias("demand_interval"),
        F.try_divide("state.size", "state.gap").alias("forecast"),
    )
