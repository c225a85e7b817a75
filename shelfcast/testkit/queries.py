"""One query per operator and pipeline, over a folder of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas
from shelfcast.functions import calendar_columns, city_key
from shelfcast.operators import (
    backtest,
    effects,
    encoding,
    filters,
    forecast,
    importance,
    joins,
    quality,
    signals,
    sketches,
    smoothing,
    star,
    windows,
)
from shelfcast.plans import audit, boosting, incremental, training
from shelfcast.plans.ingest import StarSchema, star_schema
from shelfcast.session import fresh_path, stage, stage_all
from shelfcast.sinks import read_table, write_by_month, write_table
from shelfcast.sources import Intake, RejectCounts, read_csv, read_weather, typed
from shelfcast.testkit.files import write_topped, write_weather_files
from shelfcast.testkit.views import Inputs

# As in the contract, with the 64-bit keys of the test tables.
ITEMS = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name == "item_nbr" else f.dataType)
        for f in schemas.ITEMS
    ]
)
AVERAGES = ("temp_avg_c", "humidity_avg_pct", "apparent_avg_c")
TE_KEYS = ("family", "store_id")
CORRELATED = ("oil_price", "transactions", "temp_avg_c", "precip_total_mm")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of fractions depend on their order in the last bits; compare six digits."""
    return df.withColumns({name: F.round(name, 6) for name in columns})


# Scans and sinks.


def csv_scan(inputs: Inputs) -> DataFrame:
    path = fresh_path(inputs.spark, "train_csv")
    inputs.sales.write.option("header", True).csv(path)
    return read_csv(inputs.spark, path, schemas.SALES)


def csv_glob_scan(inputs: Inputs) -> DataFrame:
    path = fresh_path(inputs.spark, "oil_csv")
    inputs.oil.repartition(4).write.option("header", True).csv(path)
    return read_csv(inputs.spark, f"{path}/*.csv", schemas.OIL)


def parquet_roundtrip(inputs: Inputs) -> DataFrame:
    path = fresh_path(inputs.spark, "train_parquet")
    write_table(inputs.sales, path)
    return read_table(inputs.spark, path)


def partitioned_parquet(inputs: Inputs) -> DataFrame:
    path = fresh_path(inputs.spark, "series_by_month")
    calendar = calendar_columns(F.col("date"))
    months = inputs.series.withColumns({name: calendar[name] for name in ("year", "month")})
    write_by_month(months, path)
    return read_table(inputs.spark, path)


def _weather_files(inputs: Inputs) -> DataFrame:
    path = fresh_path(inputs.spark, "weather_files")
    write_weather_files(inputs.weather_hourly, path)
    return read_weather(inputs.spark, path)


#: Shapes of a time that a weather file may use, by name.
TIME_SHAPES = {
    "blank": schemas.WEATHER_TIME_FORMAT,
    "letter": "yyyy-MM-dd'T'HH:mm",
    "seconds": "yyyy-MM-dd HH:mm:ss",
}


def weather_time_shapes(inputs: Inputs) -> DataFrame:
    """All readings, written in each shape and read back."""
    read = []
    for shape, pattern in TIME_SHAPES.items():
        path = fresh_path(inputs.spark, f"weather_{shape}")
        write_weather_files(inputs.weather_hourly, path, pattern)
        hourly = read_weather(inputs.spark, path).drop("date")
        read.append(hourly.select(F.lit(shape).alias("shape"), "*"))
    return reduce(DataFrame.unionAll, read)


def weather_files_daily(inputs: Inputs) -> DataFrame:
    return _rounded(signals.weather_daily(_weather_files(inputs)), *AVERAGES)


def csv_perishable_spellings(inputs: Inputs) -> DataFrame:
    """The item dimension from files that spell yes and no in different ways."""
    marked, built = F.col("perishable") == 1, []
    spellings = (("number", "1", "0"), ("fraction", "1.0", "0.0"), ("word", "True", "False"))
    for spelling, yes, no in spellings:
        path = fresh_path(inputs.spark, f"items_{spelling}")
        spelled = inputs.items.withColumn("perishable", F.when(marked, yes).otherwise(no))
        spelled.write.option("header", True).csv(path)
        items = star.item_dimension(read_csv(inputs.spark, path, ITEMS))
        built.append(items.select(F.lit(spelling).alias("spelling"), "*"))
    return reduce(DataFrame.unionAll, built)


def csv_rejects(inputs: Inputs) -> DataFrame:
    """Sales with item numbers and promotions that do not parse, counted while written."""
    path, counts = fresh_path(inputs.spark, "train_rejects"), RejectCounts()
    spoilt = inputs.sales.withColumns(
        {
            "item_nbr": F.when(F.col("item_nbr") % 10 == 0, "none").otherwise(
                F.col("item_nbr").cast("string")
            ),
            "onpromotion": F.when(F.col("store_nbr") % 4 == 0, "maybe").otherwise(
                F.col("onpromotion")
            ),
        }
    )
    spoilt.write.option("header", True).csv(path)
    sales = counts.read_csv(inputs.spark, path, schemas.SALES, "sales")
    write_table(sales, fresh_path(inputs.spark, "train_typed"))
    return counts.table(inputs.spark)


def csv_quarantine(inputs: Inputs) -> DataFrame:
    """Every bad value of sales in several files, some of whose lines also lack a field."""
    path, intake = fresh_path(inputs.spark, "train_quarantine"), Intake()
    number, promoted = F.col("item_nbr").cast("string"), F.col("onpromotion")
    fields = [
        F.col("date").cast("string"),
        F.col("store_nbr").cast("string"),
        F.when(F.col("item_nbr") % 10 == 0, F.concat(F.lit("no "), number)).otherwise(number),
        F.when(F.col("item_nbr") % 15 == 0, "1,5").otherwise(F.col("unit_sales").cast("string")),
        F.when(F.col("store_nbr") % 4 == 0, "maybe").otherwise(F.coalesce(promoted, F.lit(""))),
    ]
    part = F.pmod("store_nbr", F.lit(3)).cast("int")
    lines = inputs.sales.select(part.alias("part"), F.concat_ws(",", *fields).alias("value"))
    write_topped(lines, "part", ",".join(schemas.SALES.names), path)
    intake.read_csv(inputs.spark, f"{path}/*/*.txt", schemas.SALES, "sales")
    place = F.regexp_extract("file", "part=([0-9])", 1).cast("int")
    return intake.bad_values().withColumn("file", place)


def weather_preamble_strip(inputs: Inputs) -> DataFrame:
    return _weather_files(inputs).drop("date")


def file_city_key(inputs: Inputs) -> DataFrame:
    return _weather_files(inputs).select("city_norm").distinct()


# Projections, filters, null handling.


def project_rename_cast(inputs: Inputs) -> DataFrame:
    names = {"store_nbr": "store_id", "item_nbr": "item_id"}
    return typed(inputs.sales, schemas.SALES).withColumnsRenamed(names)


def normalize_city(inputs: Inputs) -> DataFrame:
    return inputs.stores.select(
        F.col("store_nbr").alias("store_id"), city_key(F.col("city")).alias("city_norm")
    )


def filter_perishable_any(inputs: Inputs) -> DataFrame:
    marked = F.col("perishable")
    spellings = {
        "number": marked,
        "boolean": marked.cast("boolean"),
        "text": F.when(marked == 1, "True").otherwise("0"),
    }
    kept = [
        filters.perishable(inputs.items.withColumn("perishable", spelling)).select(
            F.lit(kind).alias("kind"), "item_nbr"
        )
        for kind, spelling in spellings.items()
    ]
    return reduce(DataFrame.unionAll, kept)


def null_fill(inputs: Inputs) -> DataFrame:
    return joins.fill_signals(_with_date_signals(inputs, transactions=True))


# Joins.


def _with_date_signals(inputs: Inputs, transactions: bool = False) -> DataFrame:
    oil = stage(inputs.features.oil, "oil")
    holidays = stage(signals.holiday_dates(inputs.holidays), "holiday_dates")
    joined = joins.with_national(inputs.series, oil, holidays)
    return _with_transactions(inputs, joined) if transactions else joined


def _with_transactions(inputs: Inputs, fact: DataFrame) -> DataFrame:
    return joins.with_transactions(fact, stage(inputs.features.transactions, "transactions"))


def _with_city(inputs: Inputs) -> DataFrame:
    dim_store = stage(inputs.dim_store, "dim_store")
    return joins.with_city(inputs.series, star.store_cities(dim_store))


def join_dim_item(inputs: Inputs) -> DataFrame:
    return joins.with_item(inputs.fact_sales, stage(inputs.dim_item, "dim_item"))


def join_city_day(inputs: Inputs) -> DataFrame:
    return joins.with_weather(_with_city(inputs), stage(inputs.features.weather, "weather"))


# Aggregations.


def weather_daily(inputs: Inputs) -> DataFrame:
    return _rounded(signals.weather_daily(inputs.rollup_hourly), *AVERAGES)


def rolling_means(inputs: Inputs) -> DataFrame:
    means = windows.with_trailing_means(inputs.fractional_series)
    return _rounded(means, "unit_sales", *[f"roll_mean_{n}" for n in schemas.TRAILING_DAYS])


def sample_rows(inputs: Inputs) -> DataFrame:
    return quality.sample_rows(weather_daily(inputs), 5, "date", "city_norm")


def _star(inputs: Inputs) -> StarSchema:
    return star_schema(inputs.items, inputs.stores, inputs.sales)


def stage_row_counts(inputs: Inputs) -> DataFrame:
    return audit.row_counts(_star(inputs), inputs.features)


def fan_out(inputs: Inputs) -> DataFrame:
    return audit.fan_out(_star(inputs), inputs.features)


def null_rates(inputs: Inputs) -> DataFrame:
    return quality.null_rates(inputs.sales)


# Pipelines.


def enrich_sales(inputs: Inputs) -> DataFrame:
    star_tables, features = inputs.stored("dim_store")
    fact = inputs.series.drop("family")
    return training.enriched_sales(fact, star_tables["dim_store"], features)


def model_base(inputs: Inputs) -> DataFrame:
    star_tables, features = inputs.stored("dim_item", "dim_store")
    tables = StarSchema(**star_tables, fact_sales=inputs.fact_sales)
    return training.model_base(tables, features)


def model_train(inputs: Inputs) -> DataFrame:
    star_tables, features = inputs.stored("dim_store")
    return training.training_table(inputs.series, star_tables["dim_store"], features)


def model_train_incremental(inputs: Inputs) -> DataFrame:
    """All but the last three months first, then those in two updates."""
    star_tables, features = inputs.stored("dim_store")
    series, out = stage(inputs.series, "series"), fresh_path(inputs.spark, "incremental")
    last = incremental.month_of(series.agg(F.max("date")).first()[0])
    cut, second = incremental.month_of(last, -2), incremental.month_of(last, -1)
    tables = (star_tables["dim_store"], features, out)
    before = series.where(F.col("date") < F.lit(cut))
    incremental.build(inputs.spark, before, *tables)
    some = series.where(F.col("date") < F.lit(last))
    incremental.extend(inputs.spark, some, *tables, first=cut)
    # the second of them once more, with all that has come since
    table = incremental.extend(inputs.spark, series, *tables, first=second)
    return table.select(schemas.MODEL_TRAIN)


# Forecasts.


def _history(inputs: Inputs) -> DataFrame:
    """The training table's rows with their history, which needs no signal."""
    history = filters.warmed_up(windows.with_history(inputs.series))
    return history.withColumnRenamed("unit_sales", "y")


def baseline_forecast(inputs: Inputs) -> DataFrame:
    return forecast.baseline_forecasts(_history(inputs))


def forecast_error(inputs: Inputs) -> DataFrame:
    errors = forecast.forecast_errors(baseline_forecast(inputs))
    return _rounded(errors, "mae", "rmse", "bias")


def holdout_errors(inputs: Inputs) -> DataFrame:
    """Errors on the later dates, those that the boosted trees are judged by."""
    history = stage(_history(inputs), "history")
    later = history.where(F.col("date") > F.lit(boosting.split_date(history)))
    errors = forecast.forecast_errors(forecast.baseline_forecasts(later))
    return _rounded(errors, "mae", "rmse", "bias")


def factor_effect(inputs: Inputs) -> DataFrame:
    holidays = stage(signals.holiday_dates(inputs.holidays), "holiday_dates")
    rows = joins.fill_signals(joins.with_national(_history(inputs), holidays))
    weekend = calendar_columns(F.col("date"))["is_weekend"]
    return forecast.factor_effect(rows.withColumn("is_weekend", weekend))


def factor_correlation(inputs: Inputs) -> DataFrame:
    lookups = {name: getattr(inputs.features, name) for name in ("oil", "transactions", "weather")}
    stored = stage_all({**lookups, "dim_store": inputs.dim_store})
    rows = joins.with_transactions(_history(inputs), stored["transactions"])
    rows = joins.with_city(rows, star.store_cities(stored["dim_store"]))
    rows = joins.with_weather(joins.with_national(rows, stored["oil"]), stored["weather"])
    found = forecast.factor_correlation(joins.fill_signals(rows), CORRELATED)
    return _rounded(found, "correlation")


def target_encoding(inputs: Inputs) -> DataFrame:
    history = stage(_history(inputs).select("date", *TE_KEYS, "y"), "history")
    found = encoding.with_target_encoding(history, TE_KEYS)
    return _rounded(found, *map(encoding.encoded, TE_KEYS))


def backtest_errors(inputs: Inputs) -> DataFrame:
    """Baselines judged from four origins, by weeks ahead."""
    rows = windows.with_history(inputs.series).withColumnRenamed("unit_sales", "y")
    history = stage(rows, "history")
    last = history.agg(F.max("date")).first()[0]
    made = backtest.forecasts_from(history, backtest.origins(last))
    return _rounded(backtest.errors_by_origin(made), "mae", "rmse", "bias")


def error_interval(inputs: Inputs) -> DataFrame:
    found = backtest.improvement_interval(baseline_forecast(inputs))
    return _rounded(found, "improvement", "low", "high")


def adjusted_effect(inputs: Inputs) -> DataFrame:
    """Effects of holiday, weekend and promotion, adjusted for each other and the series."""
    holidays = stage(signals.holiday_dates(inputs.holidays), "holiday_dates")
    rows = joins.fill_signals(joins.with_national(_history(inputs), holidays))
    weekend = calendar_columns(F.col("date"))["is_weekend"]
    rows = rows.withColumn("is_weekend", weekend)
    return _rounded(effects.adjusted_effects(rows, forecast.FACTORS), "effect")


BLEND = ("lag_1", "lag_7", "roll_mean_28")


def permutation_importance(inputs: Inputs) -> DataFrame:
    """Of the features of a blend of baselines, in the place of the fitted trees."""
    history = stage(_history(inputs).select(*boosting.SERIES, "y", *BLEND), "history")

    def blend(values):
        return (values["lag_1"] + 2 * values["lag_7"] + 5 * values["roll_mean_28"]) / 8

    found = importance.permutation_importance(
        history, BLEND, boosting.SERIES, blend, block_rows=3000
    )
    return _rounded(found, "mae", "importance")


def merged_summaries(inputs: Inputs) -> DataFrame:
    """Monthly sketches stored, then merged by family and held against exact answers.

    A quantile is ``sound`` if its rank among the family's sales is off by no more than the
    error that the sketch states.
    """
    path = fresh_path(inputs.spark, "sketches")
    series = stage(inputs.series, "series")
    write_table(sketches.monthly_sketches(series), path)
    merged = sketches.merged_summaries(read_table(inputs.spark, path), "family")
    names = [name for name in merged.columns if name.startswith("q")]
    ranks = series.join(merged.select("family", *names), "family").groupBy("family").agg(
        *[F.avg((F.col("unit_sales") < F.col(name)).cast("int")).alias(f"lo_{name}") for name in names],
        *[F.avg((F.col("unit_sales") <= F.col(name)).cast("int")).alias(f"hi_{name}") for name in names],
    )
    sound = [
        (F.col(f"lo_q{round(q * 100)}") - sketches.RANK_ERROR <= q)
        & (q <= F.col(f"hi_q{round(q * 100)}") + sketches.RANK_ERROR)
        for q in sketches.QUANTILES
    ]
    exact = series.groupBy("family").agg(F.countDistinct("store_id").alias("exact"))
    told = merged.join(ranks, "family").join(exact, "family")
    close = F.abs(F.col("stores") - F.col("exact")) <= 0.05 * F.col("exact")
    return told.select("family", "records", "units", close.alias("stores_sound"), reduce(Column.__and__, sound).alias("sound"))


def smoothed_forecast(inputs: Inputs) -> DataFrame:
    found = smoothing.smoothed_demand(inputs.series)
    return _rounded(found, "demand_size", "demand_interval", "forecast")


def table_fingerprint(inputs: Inputs) -> DataFrame:
    """The fact and its rollup, and both again from parquet, one of them by month."""
    fact, series = fresh_path(inputs.spark, "fact"), fresh_path(inputs.spark, "months")
    write_table(inputs.fact_sales, fact)
    calendar = calendar_columns(F.col("date"))
    months = inputs.series.withColumns({name: calendar[name] for name in ("year", "month")})
    write_by_month(months, series)
    return quality.fingerprints(
        {
            "fact": inputs.fact_sales,
            "stored fact": read_table(inputs.spark, fact),
            "series": inputs.series,
            "stored series": read_table(inputs.spark, series).drop("year", "month"),
        }
    )


def _fit(inputs: Inputs) -> boosting.Fit:
    return boosting.fit(stage(model_train(inputs), "model_train"))


def boosted_forecast(inputs: Inputs) -> DataFrame:
    return _fit(inputs).comparison()


def feature_importance(inputs: Inputs) -> DataFrame:
    return boosting.importance_table(inputs.spark, _fit(inputs))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "csv_scan": csv_scan,
    "csv_glob_scan": csv_glob_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "partitioned_parquet": partitioned_parquet,
    "csv_perishable_spellings": csv_perishable_spellings,
    "csv_rejects": csv_rejects,
    "csv_quarantine": csv_quarantine,
    "weather_preamble_strip": weather_preamble_strip,
    "weather_time_shapes": weather_time_shapes,
    "file_city_key": file_city_key,
    "project_rename_cast": project_rename_cast,
    "normalize_city": normalize_city,
    "filter_returns": lambda i: filters.without_returns(i.sales),
    "filter_perishable": lambda i: filters.perishable(i.items),
    "filter_perishable_any": filter_perishable_any,
    "dim_item": lambda i: i.dim_item,
    "dim_store": lambda i: i.dim_store,
    "join_fact_perishable": lambda i: star.of_perishables(i.sales, i.items),
    "fact_sales": lambda i: i.fact_sales,
    "join_dim_item": join_dim_item,
    "join_store_city": _with_city,
    "join_date_signals": _with_date_signals,
    "join_store_day": lambda i: _with_transactions(i, i.series),
    "join_city_day": join_city_day,
    "null_fill": null_fill,
    "holiday_flag": lambda i: signals.holiday_dates(i.holidays),
    "holidays_daily": lambda i: i.features.holidays,
    "feat_oil_daily": lambda i: i.features.oil,
    "feat_transactions_daily": lambda i: i.features.transactions,
    "feat_weather_daily_city": lambda i: i.features.weather,
    "weather_daily": weather_daily,
    "weather_files_daily": weather_files_daily,
    "weather_profile": lambda i: quality.weather_profile(weather_daily(i)),
    "rows_per_city": lambda i: quality.rows_per(weather_daily(i), "city_norm"),
    "sample_rows": sample_rows,
    "distinct_stores": lambda i: quality.distinct_values(
        i.fact_sales, "store_id", "num_stores"
    ),
    "stage_row_counts": stage_row_counts,
    "fan_out": fan_out,
    "null_rates": null_rates,
    "sales_rejects": lambda i: quality.sales_rejects(i.sales),
    "daily_fact": lambda i: i.series,
    "calendar_features": lambda i: i.series.withColumns(calendar_columns(F.col("date"))),
    "lag_features": lambda i: filters.warmed_up(windows.with_lags(i.series)),
    "rolling_means": rolling_means,
    "enrich_sales": enrich_sales,
    "model_base": model_base,
    "model_train": model_train,
    "model_train_incremental": model_train_incremental,
    "baseline_forecast": baseline_forecast,
    "forecast_error": forecast_error,
    "holdout_errors": holdout_errors,
    "factor_effect": factor_effect,
    "factor_correlation": factor_correlation,
    "sales_by_family_month": lambda i: forecast.sales_by_family_month(i.series),
    "daily_totals": lambda i: forecast.daily_totals(i.series),
    "store_totals": lambda i: forecast.store_totals(i.series),
    "target_encoding": target_encoding,
    "backtest_errors": backtest_errors,
    "error_interval": error_interval,
    "adjusted_effect": adjusted_effect,
    "permutation_importance": permutation_importance,
    "smoothed_forecast": smoothed_forecast,
    "merged_summaries": merged_summaries,
    "table_fingerprint": table_fingerprint,
    "boosted_forecast": boosted_forecast,
    "feature_importance": feature_importance,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Inputs(spark, folder))
