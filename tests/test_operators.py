from conftest import day, rows
from pyspark.sql import Row
from pyspark.sql import functions as F
import pytest

from shelfcast import schemas
from shelfcast.operators import filters, forecast, joins, quality, signals, star

D = day("2024-01-01")


def test_returns_filter(spark):
    sales = spark.createDataFrame(
        [(-1.0,), (0.0,), (2.5,), (None,), (float("nan"),)], "unit_sales double"
    )
    assert rows(filters.without_returns(sales)) == [(0.0,), (2.5,)]
    undated = sales.withColumn("date", F.when(F.col("unit_sales") > 1, F.current_date()))
    assert rows(quality.sales_rejects(undated)) == [(1, 1, 1, 3)]


@pytest.mark.parametrize(
    "dtype, values, kept",
    [
        ("boolean", [True, False, None], [True]),
        ("int", [1, 0, 2, None], [1]),
        ("double", [1.0, 0.0, None], [1.0]),
        ("string", ["1", "True", "yes", " true ", "0", "no", "", "x", None],
         [" true ", "1", "True", "yes"]),
    ],
)
def test_perishable_in_any_type(spark, dtype, values, kept):
    items = spark.createDataFrame([(v,) for v in values], f"perishable {dtype}")
    assert sorted(row[0] for row in filters.perishable(items).collect()) == kept


def _items(spark):
    return spark.createDataFrame(
        [(1, "DAIRY", 10, 1), (1, "DAIRY", 10, 1), (2, "BREAD", 20, 0), (3, "MEATS", 30, 1)],
        schemas.ITEMS,
    )


def test_item_dimension(spark):
    dim = star.item_dimension(_items(spark))
    assert dim.columns == schemas.DIM_ITEM
    assert rows(dim) == [(1, "DAIRY", 10, True), (3, "MEATS", 30, True)]


def test_store_dimension_keeps_rows_whose_attributes_differ(spark):
    stores = spark.createDataFrame(
        [(1, "Quito", "P", "D", 1), (1, "Quito", "P", "D", 1), (1, "Quito", "P", "D", 2)],
        schemas.STORES,
    )
    dim = star.store_dimension(stores)
    assert dim.columns == schemas.DIM_STORE
    assert rows(dim) == [(1, "Quito", "P", "D", 1), (1, "Quito", "P", "D", 2)]
    with pytest.raises(ValueError, match="repeats"):
        quality.assert_unique(dim, "store_id")
    assert quality.assert_unique(dim, "store_id", "cluster") is dim


def test_sales_fact(spark):
    sales = spark.createDataFrame(
        [
            (D, 5, 1, 2.0, "True"),
            (D, 5, 1, -2.0, "True"),
            (D, 5, 2, 9.0, None),
            (D, 6, 3, 0.5, None),
            (D, 6, None, 0.5, None),
        ],
        "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion string",
    )
    items = _items(spark)
    fact = star.sales_fact(sales, items)
    assert fact.columns == schemas.FACT_SALES
    # Item 1 is listed twice, so an inner join counts its sale twice.
    assert rows(fact) == [(D, 5, 1, 2.0, True), (D, 5, 1, 2.0, True), (D, 6, 3, 0.5, None)]


def test_by_day_sums_and_keeps_promotion(spark):
    fact = spark.createDataFrame(
        [(D, 1, 7, 2.0, False), (D, 1, 7, 3.0, True), (D, 1, 8, 1.0, None)],
        "date date, store_id int, item_id int, unit_sales double, onpromotion boolean",
    )
    assert rows(star.by_day(fact)) == [(D, 1, 7, 5.0, True), (D, 1, 8, 1.0, None)]
    assert rows(star.by_day(fact.drop("onpromotion"), "store_id")) == [(D, 1, 6.0)]


HOLIDAYS = [
    (D, "b", "Local", "Quito"),
    (D, "a", "National", "Ecuador"),
    (D, "a", "Local", "Loja"),
    (None, "c", "Local", "Manta"),
    (None, "b", "Local", "Manta"),
]


def test_holidays_daily_is_deterministic(spark):
    holidays = spark.createDataFrame(HOLIDAYS * 20, schemas.HOLIDAYS)
    expected = [(D, "a", "Local", "Loja"), (None, "b", "Local", "Manta")]
    for partitions in (1, 7):
        daily = signals.holidays_daily(holidays.repartition(partitions))
        assert daily.columns == ["date", "holiday_type", "locale", "locale_name"]
        assert sorted(map(tuple, daily.collect()), key=repr) == sorted(expected, key=repr)


def test_holiday_dates(spark):
    holidays = spark.createDataFrame(HOLIDAYS, schemas.HOLIDAYS)
    assert rows(signals.holiday_dates(holidays)) == sorted([(D, 1), (None, 0)], key=repr)


def test_weather_daily(spark):
    hourly = spark.createDataFrame(
        [
            (D, "quito", 10.0, 1.0, 0.5, 50.0, 9.0),
            (D, "quito", 20.0, 2.0, None, None, 11.0),
            (D, "loja", None, None, None, None, None),
        ],
        "date date, city_norm string, " + ", ".join(
            f"{name} double" for name in schemas.WEATHER_MEASURES.values()
        ),
    )
    daily = signals.weather_daily(hourly)
    assert daily.columns == ["date", "city_norm", *schemas.DAILY_WEATHER]
    assert rows(daily) == [
        (D, "loja", *[None] * 7),
        (D, "quito", 15.0, 10.0, 20.0, 3.0, 0.5, 50.0, 10.0),
    ]


def _signals(spark):
    weather = ", ".join(f"{name} double" for name in schemas.DAILY_WEATHER)
    return {
        "store_cities": spark.createDataFrame(
            [(1, "quito"), (2, None)], "store_id int, city_norm string"
        ),
        "oil": spark.createDataFrame([(D, None)], "date date, oil_price double"),
        "transactions": spark.createDataFrame(
            [(D, 1, 30)], "date date, store_id int, transactions int"
        ),
        "holidays": spark.createDataFrame([(D, 1), (None, 0)], "date date, is_holiday int"),
        "weather": spark.createDataFrame(
            [(D, "quito", *[1.0] * 7), (D, None, *[9.0] * 7)],
            f"date date, city_norm string, {weather}",
        ),
    }


def _fact(spark):
    return spark.createDataFrame(
        [(D, 1, 7, 2.0), (day("2024-01-02"), 2, 7, 3.0), (D, 2, 7, 4.0), (None, 1, 7, 5.0)],
        "date date, store_id int, item_id int, unit_sales double",
    )


def test_signals_are_left_joined_and_filled(spark):
    joined = joins.with_signals(_fact(spark), **_signals(spark))
    found = {row.unit_sales: row for row in joined.collect()}
    assert len(found) == 4
    assert (found[2.0].transactions, found[2.0].is_holiday, found[2.0].temp_avg_c) == (30, 1, 1.0)
    # A NULL city or date matches nothing, not even a NULL on the other side.
    assert (found[4.0].city_norm, found[4.0].temp_avg_c) == (None, None)
    assert (found[5.0].is_holiday, found[5.0].city_norm) == (None, "quito")
    filled = {row.unit_sales: row for row in joins.fill_signals(joined).collect()}
    assert (filled[2.0].oil_price, filled[3.0].transactions, filled[3.0].is_holiday) == (0.0, 0, 0)
    assert filled[3.0].temp_avg_c is None


def test_fill_replaces_nan(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1, None)], "oil_price double, transactions int, is_holiday int"
    )
    assert rows(joins.fill_signals(df)) == [(0.0, 1, 0)]


def test_repeated_signal_keys_multiply_rows(spark):
    parts = _signals(spark)
    parts["oil"] = parts["oil"].unionAll(parts["oil"])
    assert joins.with_signals(_fact(spark), **parts).count() == 6


def test_profile_counts_and_samples(spark):
    df = spark.createDataFrame(
        [(D, "b"), (D, "a"), (day("2024-01-05"), "a"), (None, None)], "date date, city_norm string"
    )
    assert rows(quality.weather_profile(df)) == [(D, day("2024-01-05"), 2)]
    assert [tuple(r) for r in quality.rows_per(df, "city_norm").collect()] == [
        (None, 1), ("a", 2), ("b", 1),
    ]
    assert rows(quality.distinct_values(df, "city_norm", "n")) == [(3,)]
    assert [r.city_norm for r in quality.sample_rows(df.dropna(), 2, "date", "city_norm").collect()
            ] == ["a", "b"]
    assert rows(quality.null_rates(df)) == [(0.25, 0.25)]
    counts = quality.stage_row_counts({"all": df, "known": df.dropna()})
    assert rows(counts) == [("all", 4), ("known", 3)]


def test_forecast_errors_per_family_and_overall(spark):
    forecasts = spark.createDataFrame(
        [("A", 10.0, 8.0, 10.0, None), ("A", 10.0, 14.0, 10.0, 1.0), ("B", 0.0, 3.0, 0.0, None)],
        "family string, y double, naive double, seasonal_naive double, moving_average double",
    )
    found = {(r.model, r.family): r for r in forecast.forecast_errors(forecasts).collect()}
    assert found["naive", "A"].mae == 3.0
    assert found["naive", "A"].bias == 1.0
    assert found["naive", "A"].rmse == pytest.approx(10.0**0.5)
    assert (found["naive", "(all)"].mae, found["naive", "(all)"].n) == (3.0, 3)
    assert found["seasonal_naive", "(all)"].mae == 0.0
    assert (found["moving_average", "(all)"].mae, found["moving_average", "(all)"].n) == (9.0, 1)
    assert found["moving_average", "B"].mae is None


def test_factor_effect(spark):
    training = spark.createDataFrame(
        [(1.0, 1, 0, True), (3.0, 0, 0, None), (5.0, 0, 1, True)],
        "y double, is_holiday int, is_weekend int, onpromotion boolean",
    )
    found = {(r.factor, r.level): (r.n, r.mean_y) for r in forecast.factor_effect(training).collect()}
    assert found == {
        ("is_holiday", "1"): (1, 1.0),
        ("is_holiday", "0"): (2, 4.0),
        ("is_weekend", "0"): (2, 2.0),
        ("is_weekend", "1"): (1, 5.0),
        ("onpromotion", "1"): (2, 3.0),
        ("onpromotion", None): (1, 3.0),
    }


def test_factor_correlation(spark):
    training = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 4.0), (3.0, 6.0, 3.0), (9.0, None, 0.0)],
        "y double, up double, down double",
    )
    found = dict(forecast.factor_correlation(training, ("up", "down")).collect())
    assert found["up"] == pytest.approx(1.0)
    assert found["down"] < -0.9


def test_fact_level_summaries(spark):
    fact = spark.createDataFrame(
        [
            Row(date=D, store_id=1, family="A", unit_sales=1.0),
            Row(date=D, store_id=2, family="A", unit_sales=2.0),
            Row(date=day("2024-02-01"), store_id=1, family="A", unit_sales=4.0),
        ]
    )
    assert rows(forecast.sales_by_family_month(fact)) == [
        ("A", 2024, 1, 3.0, 2, 2), ("A", 2024, 2, 4.0, 1, 1),
    ]
    assert rows(forecast.daily_totals(fact)) == [(D, 3.0, 2), (day("2024-02-01"), 4.0, 1)]
    assert rows(forecast.store_totals(fact)) == [(1, 5.0, 2), (2, 2.0, 1)]
