"""Lags, trailing means and the training table against a row-by-row computation."""

import datetime as dt
import random

import pytest
from conftest import day, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import calendar_columns
from shelfcast.operators import filters, joins, signals, star, windows
from shelfcast.plans import training
from shelfcast.plans.features import FeatureTables
from shelfcast.plans.ingest import StarSchema

START = day("2024-01-01")


def _sales(lengths: dict, seed: int = 1):
    """Series with gaps between dates and fractional units."""
    rng = random.Random(seed)
    data = []
    for (store, item), length in lengths.items():
        date = START
        for _ in range(length):
            date += dt.timedelta(days=rng.choice((1, 1, 1, 2, 9)))
            data.append((date, store, item, rng.randrange(0, 400) / 8, rng.random() < 0.3))
    rng.shuffle(data)
    return data


FACT = "date date, store_id int, item_id int, unit_sales double, onpromotion boolean"


def _expected(data):
    """History per (store, item, date), by walking each series."""
    series: dict = {}
    for date, store, item, units, _ in sorted(data):
        series.setdefault((store, item), []).append((date, units))
    out = {}
    for key, points in series.items():
        units = [u for _, u in points]
        for i, (date, _) in enumerate(points):
            lags = [units[i - n] if i >= n else None for n in schemas.LAGS]
            means = []
            for n in schemas.TRAILING_DAYS:
                before = units[max(0, i - n) : i]
                means.append(sum(before) / len(before) if before else None)
            out[(*key, date)] = (*lags, *means)
    return out


HISTORY = [f"lag_{n}" for n in schemas.LAGS] + [f"roll_mean_{n}" for n in schemas.TRAILING_DAYS]


@pytest.mark.parametrize("partitions", [None, 3])
def test_history_matches_row_by_row(spark, partitions):
    data = _sales({(1, 1): 70, (1, 2): 28, (2, 1): 29, (3, 9): 1})
    fact = spark.createDataFrame(data, FACT)
    found = windows.with_history(fact, partitions=partitions).collect()
    expected = _expected(data)
    assert len(found) == len(data)
    for row in found:
        assert tuple(row[name] for name in HISTORY) == pytest.approx(
            expected[row.store_id, row.item_id, row.date]
        )


def test_short_frames_and_current_row_excluded(spark):
    fact = spark.createDataFrame(
        [(START + dt.timedelta(days=i), 1, 1, float(i), None) for i in range(4)], FACT
    )
    means = windows.with_trailing_means(fact).orderBy("date").collect()
    assert [row.roll_mean_7 for row in means] == [None, 0.0, 0.5, 1.0]


def test_means_skip_nulls_and_take_other_lengths(spark):
    units = [1.0, None, 4.0, None, None, None, 7.0, 2.0]
    fact = spark.createDataFrame(
        [(START + dt.timedelta(days=i), 1, 1, u, None) for i, u in enumerate(units)], FACT
    )
    found = windows.with_trailing_means(fact, lengths=(2, 3)).orderBy("date").collect()
    assert [row.roll_mean_2 for row in found] == [None, 1.0, 1.0, 4.0, 4.0, None, None, 7.0]
    assert [row.roll_mean_3 for row in found] == [None, 1.0, 1.0, 2.5, 4.0, 4.0, None, 7.0]
    assert found[0].roll_mean_2 is None
    assert windows.with_trailing_means(fact).columns == [
        *fact.columns, "roll_mean_7", "roll_mean_14", "roll_mean_28",
    ]


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.integers(1, 3),
            st.integers(0, 80),
            st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
        ),
        min_size=1,
        max_size=120,
        unique_by=lambda row: row[:2],
    )
)
def test_history_of_any_series(spark, points):
    """Any gaps, NULLs and magnitudes, against Spark's own sliding averages."""
    fact = spark.createDataFrame(
        [(START + dt.timedelta(days=d), s, 1, u, None) for s, d, u in points], FACT
    )
    rows_before = Window.partitionBy("store_id", "item_id").orderBy("date")
    direct = {
        f"direct_{n}": F.avg("unit_sales").over(rows_before.rowsBetween(-n, -1))
        for n in schemas.TRAILING_DAYS
    }
    for row in windows.with_trailing_means(fact).withColumns(direct).collect():
        for n in schemas.TRAILING_DAYS:
            found, expected = row[f"roll_mean_{n}"], row[f"direct_{n}"]
            assert (found is None) == (expected is None)
            assert found is None or found == pytest.approx(expected, rel=1e-9, abs=1e-6)


def test_warm_up_drops_28_rows_of_each_series(spark):
    data = _sales({(1, 1): 28, (1, 2): 29, (2, 1): 40})
    kept = filters.warmed_up(windows.with_lags(spark.createDataFrame(data, FACT)))
    counts = {(r.store_id, r.item_id): r["count"] for r in kept.groupBy("store_id", "item_id").count().collect()}
    assert counts == {(1, 2): 1, (2, 1): 12}


@pytest.fixture
def inputs(spark):
    data = _sales({(1, 1): 60, (1, 2): 45, (2, 1): 33, (9, 3): 50})
    dates = sorted({row[0] for row in data})
    weather = ", ".join(f"{name} double" for name in schemas.DAILY_WEATHER)
    dim_item = spark.createDataFrame(
        [(1, "DAIRY", 10, True), (2, "BREAD", 20, True), (3, "MEATS", 30, False)],
        "item_id int, family string, class int, perishable boolean",
    )
    dim_store = spark.createDataFrame(
        [(1, " El%20Carmen ", "P", "D", 1), (2, "Loja", "L", "A", 2)],
        "store_id int, city string, state string, store_type string, cluster int",
    )
    features = FeatureTables(
        oil=spark.createDataFrame(
            [(d, None if d.day == 1 else d.day * 1.5) for d in dates[::2]],
            "date date, oil_price double",
        ),
        transactions=spark.createDataFrame(
            [(d, 1, d.day) for d in dates[::3]], "date date, store_id int, transactions int"
        ),
        holidays=spark.createDataFrame(
            [(d, "Holiday", "National", "Ecuador") for d in dates[::5]],
            "date date, holiday_type string, locale string, locale_name string",
        ),
        weather=signals.with_city_key(
            spark.createDataFrame(
                [(d, "El%20Carmen", *[d.day / 2] * 7) for d in dates],
                f"date date, city_norm string, {weather}",
            )
        ),
    )
    return data, spark.createDataFrame(data, FACT), dim_item, dim_store, features


def _joined_first(fact, dim_item, dim_store, features):
    """The training table in the other order: join, then history, then warm-up."""
    sales = joins.with_item(fact, dim_item.select("item_id", "family", "perishable"))
    joined = joins.fill_signals(
        joins.with_signals(
            sales,
            star.store_cities(dim_store),
            features.oil,
            features.transactions,
            features.holidays.select("date", F.lit(1).alias("is_holiday")),
            features.weather.withColumn("city_norm", F.lit("el carmen")),
        )
    ).withColumns(calendar_columns(F.col("date")))
    history = filters.warmed_up(windows.with_history(joined))
    return history.withColumnRenamed("unit_sales", "y").select(schemas.MODEL_TRAIN)


@pytest.mark.parametrize("daily", [True, False])
def test_training_table(inputs, daily):
    data, fact, dim_item, dim_store, features = inputs
    series = training.perishable_series(fact, dim_item, daily)
    table = training.training_table(series, dim_store, features)
    assert table.columns == schemas.MODEL_TRAIN
    assert len(table.columns) == 30
    assert rows(table) == rows(_joined_first(fact, dim_item, dim_store, features))
    assert table.count() == (60 - 28) + (45 - 28) + (33 - 28)


def test_training_table_repairs_split_days(inputs):
    """A day's sales in several records count as that day's sum."""
    data, fact, dim_item, dim_store, features = inputs
    half = fact.withColumn("unit_sales", F.col("unit_sales") / 2)
    split = training.perishable_series(half.unionAll(half), dim_item)
    whole = training.perishable_series(fact, dim_item)
    assert rows(training.training_table(split, dim_store, features)) == rows(
        training.training_table(whole, dim_store, features)
    )


def test_no_feature_sees_the_current_or_later_days(inputs, spark):
    data, _, dim_item, dim_store, features = inputs
    last = max(row[0] for row in data)
    changed = [(d, s, i, u + 1000 if d == last else u, p) for d, s, i, u, p in data]

    def table(sales):
        series = training.perishable_series(spark.createDataFrame(sales, FACT), dim_item)
        return training.training_table(series, dim_store, features).drop("y")

    assert rows(table(data)) == rows(table(changed))


def test_enriched_sales_and_model_base(inputs):
    data, fact, dim_item, dim_store, features = inputs
    enriched = training.enriched_sales(fact, dim_store, features)
    assert enriched.columns == schemas.ENRICHED_SALES
    assert len(enriched.columns) == 16
    assert enriched.count() == len(data)
    assert enriched.filter("temp_avg_c IS NULL").count() == enriched.filter("store_id <> 1").count()
    base = training.model_base(StarSchema(dim_item, dim_store, fact), features)
    assert base.columns == schemas.MODEL_BASE
    assert len(base.columns) == 21
    assert base.filter("item_id = 3").count() == 0
    assert base.filter("oil_price IS NULL").count() > 0
