"""Boosted-tree forecast on the training table, trained by Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions.calendar import flag
from shelfcast.operators import backtest, effects, encoding, importance
from shelfcast.operators.forecast import BASELINES, forecast_errors
from shelfcast.session import stage
from shelfcast.sinks import Release, read_table

TRAIN_SHARE = 0.8
EFFECTS = ("is_holiday", "is_weekend", "onpromotion", "oil_price", "transactions")
_NOT_FEATURES = {"date", "store_id", "item_id", "y", "family", "onpromotion"}
_NUMERIC = [name for name in schemas.MODEL_TRAIN if name not in _NOT_FEATURES]
#: What tells series apart: how their family, store and item sold on earlier dates.
ENCODED = [encoding.encoded(key) for key in encoding.KEYS]
FEATURES = [*_NUMERIC, "promoted", "has_weather", *ENCODED]
SERIES = ("date", "store_id", "item_id")


@dataclass(frozen=True)
class Fit:
    model: GBTRegressionModel
    forecasts: DataFrame
    later: DataFrame

    def comparison(self) -> DataFrame:
        """Errors of the trees and of the baselines on the same later dates."""
        return forecast_errors(self.forecasts, (*BASELINES, "boosted"))

    def importances(self) -> dict[str, float]:
        return dict(zip(FEATURES, self.model.featureImportances.toArray().tolist()))


    def permutation_importance(self) -> DataFrame:
        """What the error on the later dates gains if a feature is exchanged between rows."""
        rows = stage(self.later.select(*SERIES, "y", *FEATURES), "later")
        each = importance.variants(importance.exchanged(rows, FEATURES, SERIES), FEATURES)
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        return importance.losses(self.model.transform(assembler.transform(each)), "boosted")


def importance_table(spark: SparkSession, found: Fit) -> DataFrame:
    """``feature, importance``, one row per feature."""
    rows = [*found.importances().items()]
    return spark.createDataFrame(rows, "feature string, importance double")


def run(spark: SparkSession, out: str) -> list[str]:
    """Fit on the stored training table; store forecasts and what is known of them.

    Those are errors, the improvement on the naive forecast with its interval, importances,
    and the factors' effects on the training table. Together they take the stored ones' place.
    """
    training = read_table(spark, f"{out}/model_train")
    found = fit(training)
    with Release(spark, out) as release:
        forecasts = release.write(found.forecasts, "forecasts")
        tables = {
            "forecast_errors": forecast_errors(forecasts, (*BASELINES, "boosted")).orderBy(
                "family", "mae"
            ),
            "error_interval": backtest.improvement_interval(
                forecasts, models=("seasonal_naive", "moving_average", "boosted")
            ),
            "feature_importance": importance_table(spark, found).orderBy(F.desc("importance")),
            "permutation_importance": found.permutation_importance().orderBy(
                F.desc("importance")
            ),
            "adjusted_effects": effects.adjusted_effects(training, EFFECTS),
        }
        for name, table in tables.items():
            release.write(table.coalesce(1), name)
        release.publish("forecasts", *tables)
    return [*tables]


def _assembled(training: DataFrame) -> DataFrame:
    """Feature vectors. Unknown weather is 0, told apart by ``has_weather``."""
    known = encoding.with_target_encoding(training).withColumns(
        {
            "promoted": flag(F.col("onpromotion")),
            "has_weather": F.col("temp_avg_c").isNotNull().cast("int"),
        }
    ).fillna(0.0, subset=schemas.DAILY_WEATHER)
    known = stage(known, "encoded")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known)


def split_date(training: DataFrame, share: float = TRAIN_SHARE):
    """The date up to which rows train: ``share`` of the way through the calendar."""
    days = F.datediff(F.max("date"), F.min("date"))
    first = F.min("date")
    return training.agg(F.date_add(first, F.floor(days * share).cast("int"))).first()[0]


def fit(
    training: DataFrame, trees: int = 20, depth: int = 5, share: float = TRAIN_SHARE
) -> Fit:
    """Train on the earlier dates and forecast the later ones, next to the baselines.

    ``training`` should be a stored table: boosting reads it once per pass.
    """
    data, cut = _assembled(training), F.lit(split_date(training, share))
    model = GBTRegressor(
        labelCol="y", predictionCol="boosted", maxIter=trees, maxDepth=depth, seed=42
    ).fit(data.filter(F.col("date") <= cut))
    later = data.filter(F.col("date") > cut)
    made = model.transform(later)
    baselines = [F.col(feature).alias(name) for name, feature in BASELINES.items()]
    keys = ("date", "store_id", "item_id", "family", "y")
    return Fit(model, made.select(*keys, *baselines, "boosted"), later)
