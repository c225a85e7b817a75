"""Forecasts judged from several origins, and how sure a difference between models is."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.forecast import BASELINES
from shelfcast.operators.windows import ITEM_SERIES

FOLDS = 4
HORIZON = 28
STEP = 14
WEEK = 7
REPLICATES = 200
#: Share of the replicates that lies outside of an interval, on each side.
TAIL = 0.025


# --- rolling origins --------------------------------------------------------------------


def origins(last: dt.date, folds: int = FOLDS, horizon: int = HORIZON, step: int = STEP) -> list:
    """The last known date of each fold: the latest horizon ends with the data."""
    return [last - dt.timedelta(days=horizon + step * fold) for fold in range(folds)]


def forecasts_from(
    history: DataFrame,
    known: Sequence[dt.date],
    horizon: int = HORIZON,
    keys: Sequence[str] = ITEM_SERIES,
    measure: str = "y",
) -> DataFrame:
    """Baseline forecasts made at each origin for the dates up to ``horizon`` days later.

    ``history`` has every row of the series, with its lags and means, also those at the start.
    A row goes to each fold whose horizon holds it, in one pass. What a model knows at an
    origin are the lags and means of the first row after it; a series takes part in a fold if
    that row has a full history. The seasonal model repeats the last seven rows before the
    origin, by row as the lags are.
    """
    every = F.array(*[F.lit(date) for date in known]).cast("array<date>")
    date = F.col("date")
    mine = F.filter(every, lambda at: (at < date) & (date <= F.date_add(at, horizon)))
    fold = Window.partitionBy(*keys, "origin").orderBy("date")
    rows = history.withColumn("origin", F.explode(mine)).withColumn(
        "_step", F.row_number().over(fold)
    )
    weeks = range(math.ceil(horizon / WEEK))
    seasonal = F.coalesce(
        *[
            F.when(
                F.floor((F.col("_step") - 1) / WEEK) == week,
                F.lag("lag_7", WEEK * week).over(fold),
            )
            for week in weeks
        ]
    )
    first = {
        name: F.first(column).over(fold)
        for name, column in (("naive", "lag_1"), ("moving_average", "roll_mean_7"))
    }
    ready = F.first("lag_28").over(fold).isNotNull()
    made = rows.withColumns({**first, "seasonal_naive": seasonal, "_ready": ready})
    ahead = F.ceil(F.datediff("date", "origin") / WEEK).cast("int")
    return made.where("_ready").select(
        "origin", ahead.alias("weeks_ahead"), "date", *keys, F.col(measure).alias("y"), *BASELINES
    )


def errors_by_origin(forecasts: DataFrame, models: Sequence[str] = tuple(BASELINES)) -> DataFrame:
    """MAE, RMSE, bias and row count per origin, weeks ahead and model, in one pass."""

    def sums(model: str) -> Column:
        error = F.col(model) - F.col("y")
        return F.struct(
            F.lit(model).alias("model"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(error).alias("bias"),
            F.count(error).alias("n"),
        )

    grouped = forecasts.groupBy("origin", "weeks_ahead")
    return grouped.agg(F.array(*map(sums, models)).alias("sums")).select(
        "origin", "weeks_ahead", F.inline("sums")
    )


# --- paired bootstrap -------------------------------------------------------------------


def poisson_weight(*seed: Column) -> Column:
    """How often a unit is drawn in a bootstrap sample: Poisson with mean 1, from a hash.

    The first 32 bits of an MD5 are compared with the distribution function, which any engine
    can repeat.
    """
    text = F.concat_ws("|", *[part.cast("string") for part in seed])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 2**32
    return sum(((draw >= F.lit(cut)).cast("int") for cut in poisson_cuts()), F.lit(0))


def poisson_cuts(most: int = 9) -> list[float]:
    """The distribution function of Poisson(1), six digits, up to ``most`` draws."""
    chances = [math.exp(-1) / math.factorial(k) for k in range(most)]
    return [round(sum(chances[: k + 1]), 6) for k in range(most) if round(sum(chances[: k + 1]), 6) < 1]


def improvement_interval(
    forecasts: DataFrame,
    reference: str = "naive",
    models: Sequence[str] = ("seasonal_naive", "moving_average"),
    replicates: int = REPLICATES,
) -> DataFrame:
    """By how much each model's absolute error is less than the reference's, with an interval.

    Dates are drawn, not rows: errors of one date depend on each other. Models are compared on
    the same draws. Rows are summed to dates first, so the replicates multiply no more rows
    than the calendar has days, and each replicate is a sum of partial sums.
    """
    gain = {
        model: F.abs(F.col(reference) - F.col("y")) - F.abs(F.col(model) - F.col("y"))
        for model in models
    }
    daily = forecasts.groupBy("date").agg(
        *[
            F.struct(F.sum(value).alias("gain"), F.count(value).alias("n")).alias(model)
            for model, value in gain.items()
        ]
    )
    # replicate 0 is the data itself
    drawn = daily.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    weight = poisson_weight(F.col("replicate"), F.col("date"))
    drawn = drawn.withColumn("w", F.when(F.col("replicate") == 0, 1).otherwise(weight))
    sums = [
        F.struct(
            F.lit(model).alias("model"),
            F.try_divide(
                F.sum(F.col(f"{model}.gain") * F.col("w")), F.sum(F.col(f"{model}.n") * F.col("w"))
            ).alias("gain"),
        )
        for model in models
    ]
    each = drawn.groupBy("replicate").agg(F.array(*sums).alias("sums"))
    each = each.select("replicate", F.inline("sums"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("replicate") > 0, F.col("gain"))))
    outside = int(replicates * TAIL)
    return (
        each.groupBy("model")
        .agg(F.max(F.when(F.col("replicate") == 0, F.col("gain"))).alias("improvement"), ordered.alias("all"))
        .select(
            "model",
            "improvement",
            F.get("all", F.lit(outside)).alias("low"),
            F.get("all", F.size("all") - 1 - outside).alias("high"),
            F.size("all").alias("replicates"),
        )
    )
