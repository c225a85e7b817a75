"""Baseline forecasts, forecast errors and effects, from the training table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Baseline models, and the feature each one predicts with.
BASELINES = {
    "naive": "lag_1",
    "seasonal_naive": "lag_7",
    "moving_average": "roll_mean_7",
}
OVERALL = "(all)"
FACTORS = ("is_holiday", "is_weekend", "onpromotion")


def baseline_forecasts(training: DataFrame) -> DataFrame:
    """Actual units next to one column per baseline model."""
    return training.select(
        "date",
        "store_id",
        "item_id",
        "family",
        "y",
        *[F.col(feature).alias(model) for model, feature in BASELINES.items()],
    )


def forecast_errors(
    forecasts: DataFrame, models: Mapping[str, str] | tuple[str, ...] = tuple(BASELINES)
) -> DataFrame:
    """MAE, RMSE, bias and row count per model and family, and over all families.

    One pass: all models' sums are taken per family, and only those few rows are
    regrouped into one row per model and family.
    """
    def sums(model: str):
        error = F.col(model) - F.col("y")
        return F.struct(
            F.lit(model).alias("model"),
            F.count(error).alias("n"),
            F.sum(F.abs(error)).alias("absolute"),
            F.sum(error * error).alias("squared"),
            F.sum(error).alias("signed"),
        )

    per_family = forecasts.groupBy("family").agg(F.array(*map(sums, models)).alias("sums"))
    regrouped = (
        per_family.select("family", F.inline("sums"))
        .withColumn("family", F.explode(F.array("family", F.lit(OVERALL))))
        .groupBy("model", "family")
        .agg(*[F.sum(name).alias(name) for name in ("n", "absolute", "squared", "signed")])
    )
    return regrouped.select(
        "model",
        "family",
        (F.col("absolute") / F.col("n")).alias("mae"),
        F.sqrt(F.col("squared") / F.col("n")).alias("rmse"),
        (F.col("signed") / F.col("n")).alias("bias"),
        "n",
    )


def factor_effect(training: DataFrame, factors: tuple[str, ...] = FACTORS) -> DataFrame:
    """Mean units and row count per level of each factor.

    One pass: rows are summed per combination of levels, of which there are few,
    and the combinations are then summed per factor.
    """
    combinations = training.groupBy(*factors).agg(
        F.count("y").alias("n"), F.sum("y").alias("units")
    )
    levels = F.array(
        *[
            F.struct(
                F.lit(factor).alias("factor"),
                F.col(factor).cast("int").cast("string").alias("level"),
            )
            for factor in factors
        ]
    )
    return (
        combinations.select(F.inline(levels), "n", "units")
        .groupBy("factor", "level")
        .agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
        .select("factor", "level", "n", (F.col("units") / F.col("n")).alias("mean_y"))
    )


def factor_correlation(training: DataFrame, signals: tuple[str, ...]) -> DataFrame:
    """Pearson correlation of units with each signal, over rows that have both."""
    pairs = F.array(
        *[
            F.struct(F.lit(signal).alias("signal"), F.corr("y", signal).alias("correlation"))
            for signal in signals
        ]
    )
    return training.agg(pairs.alias("pairs")).select(F.inline("pairs"))


def sales_by_family_month(fact: DataFrame) -> DataFrame:
    """Units, records and stores that sold, per family and month."""
    return fact.groupBy(
        "family", F.year("date").alias("year"), F.month("date").alias("month")
    ).agg(
        F.sum("unit_sales").alias("units"),
        F.count("*").alias("records"),
        F.countDistinct("store_id").alias("stores"),
    )


def daily_totals(fact: DataFrame) -> DataFrame:
    """Units and records per date."""
    return fact.groupBy("date").agg(
        F.sum("unit_sales").alias("units"), F.count("*").alias("records")
    )


def store_totals(fact: DataFrame) -> DataFrame:
    """Units and records per store."""
    return fact.groupBy("store_id").agg(
        F.sum("unit_sales").alias("units"), F.count("*").alias("records")
    )
