"""The plans, and what they do with hot keys and large lookups."""

import os
import re

import pytest
from conftest import day, plan, rows, run_plan
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import filters, joins, signals, star, windows
from shelfcast.plans import training
from shelfcast.plans.features import FeatureTables
from shelfcast.session import (
    PARTITION_BYTES,
    apply_conf,
    clean,
    fresh_path,
    recommended_conf,
    run_folder,
    shared_folder,
    stage,
    stage_all,
)
from shelfcast.testkit.queries import run

TABLES_FOLDER = os.environ.get("SHELFCAST_TEST_TABLES", "/root/testdata/sf0.001")
HOT_SHARE = 3  # one key holds a third of all rows
ROWS = 60_000


def _sales(spark, n=ROWS):
    """Raw records; a third belong to store 0, item 0, and all of those to one date."""
    hot = F.col("id") % HOT_SHARE == 0
    return spark.range(n).select(
        F.when(hot, F.lit(day("2024-01-01")))
        .otherwise(F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 90).cast("int")))
        .alias("date"),
        F.when(hot, 0).otherwise(F.col("id") % 7).cast("int").alias("store_id"),
        F.when(hot, 0).otherwise(F.col("id") % 11).cast("int").alias("item_id"),
        (F.col("id") % 16).cast("double").alias("unit_sales"),
        (F.col("id") % 2 == 0).alias("onpromotion"),
    )


def _tables(spark):
    dim_item = spark.range(11).select(
        F.col("id").cast("int").alias("item_id"),
        F.concat(F.lit("F"), (F.col("id") % 3).cast("string")).alias("family"),
        F.lit(True).alias("perishable"),
    )
    dim_store = spark.range(7).select(
        F.col("id").cast("int").alias("store_id"), F.lit("Quito").alias("city")
    )
    dates = spark.range(90).select(
        F.date_add(F.lit(day("2024-01-01")), F.col("id").cast("int")).alias("date")
    )
    weather = [F.lit(1.0).alias(name) for name in schemas.DAILY_WEATHER]
    stored = stage_all(
        {
            "oil": dates.select("date", F.lit(2.0).alias("oil_price")),
            "transactions": spark.range(90 * 7).select(
                F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 90).cast("int")).alias("date"),
                F.floor(F.col("id") / 90).cast("int").alias("store_id"),
                F.lit(3).alias("transactions"),
            ),
            "holidays": dates.filter(F.dayofmonth("date") == 1).select(
                "date", *[F.lit("x").alias(n) for n in ("holiday_type", "locale", "locale_name")]
            ),
            "weather": dates.select("date", F.lit("quito").alias("city_norm"), *weather),
            "dim_item": dim_item,
            "dim_store": dim_store,
            "sales": _sales(spark),
        }
    )
    features = FeatureTables(
        **{n: stored[n] for n in ("oil", "transactions", "holidays", "weather")}
    )
    return stored["sales"], stored["dim_item"], stored["dim_store"], features


@pytest.fixture(scope="module")
def tables(spark):
    return _tables(spark)


def _training(tables, daily=False):
    sales, dim_item, dim_store, features = tables
    series = training.perishable_series(sales, dim_item, daily)
    return training.training_table(series, dim_store, features)


def _shuffles(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_training_plan_has_two_shuffles_and_one_sort(tables):
    text = plan(_training(tables))
    assert len(_shuffles(text)) == 2
    assert text.count("Window [") == 2
    assert len(re.findall(r"\+- Sort \[", text)) == 1
    assert text.count("BroadcastHashJoin") == 6
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # The warm-up filter runs before any signal is looked up.
    assert text.index("Filter isnotnull(lag_28") > text.rindex("LeftOuter")


def test_training_plan_on_daily_sales_has_one_shuffle(tables):
    text = plan(_training(tables, daily=True))
    assert len(_shuffles(text)) == 1
    assert len(re.findall(r"\+- Sort \[", text)) == 1


def test_enriching_does_not_move_the_sales(tables):
    sales, _, dim_store, features = tables
    text = plan(training.enriched_sales(sales, dim_store, features))
    # The one shuffle is the holidays' own, to make their dates distinct.
    assert [shuffle.split("#")[0] for shuffle in _shuffles(text)] == ["date"]
    assert text.count("BroadcastHashJoin") == 5 and "Sort [" not in text


def test_scans_read_only_what_they_need(tables, spark):
    text = plan(_training(tables))
    assert "ReadSchema: struct<item_id:int,family:string,perishable:boolean>" in text
    assert "PushedFilters: [IsNotNull(perishable), EqualTo(perishable,true)" in text
    monthly = signals.weather_daily(
        spark.read.schema(
            "date date, city_norm string, other string, "
            + ", ".join(f"{n} double" for n in schemas.WEATHER_MEASURES.values())
        ).parquet(_written(spark))
    ).select("date", "temp_avg_c")
    assert "ReadSchema: struct<date:date,city_norm:string,temp_c:double>" in plan(monthly)
    sold = filters.without_returns(tables[0]).select("unit_sales")
    assert "GreaterThanOrEqual(unit_sales,0.0)" in plan(sold)
    items = stage(spark.range(9).select((F.col("id") % 2).cast("int").alias("perishable")), "items")
    assert "EqualTo(perishable,1)" in plan(filters.perishable(items))


def _written(spark):
    path = fresh_path(spark, "empty")
    spark.createDataFrame([], "date date").write.parquet(path)
    return path


def test_hot_series_is_summed_before_it_moves(tables):
    """A third of the records collapse to one row per task before the shuffle."""
    sales, dim_item, _, _ = tables
    series = training.perishable_series(sales, dim_item)
    text = plan(series)
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")
    assert series.count() <= 90 * 7 * 11
    hot = series.filter("store_id = 0 AND item_id = 0 AND date = DATE'2024-01-01'")
    assert hot.count() == 1


def test_series_are_no_longer_than_the_calendar(tables):
    sales, dim_item, _, _ = tables
    longest = (
        training.perishable_series(sales, dim_item)
        .groupBy("store_id", "item_id")
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    assert longest <= 90


def _answers(tables):
    sales, dim_item, dim_store, features = tables
    enriched = training.enriched_sales(sales, dim_store, features)
    return (
        rows(_training(tables)),
        rows(enriched.groupBy(enriched.columns).count()),
    )


def test_large_lookups_are_joined_by_shuffle_with_the_same_result(tables, conf):
    expected = _answers(tables)
    for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
        conf(f"spark.sql.{name}", "-1")
    text = plan(_training(tables))
    assert "Broadcast" not in text and "SortMergeJoin" in text
    assert _answers(tables) == expected


def test_hot_keys_are_split_when_joined_by_shuffle(tables, conf):
    """A third of the sales share one key; its partition is read by several tasks."""
    sales, _, _, features = tables
    expected = joins.with_transactions(sales, features.transactions).count()
    for name, value in {
        "autoBroadcastJoinThreshold": "-1",
        "adaptive.autoBroadcastJoinThreshold": "-1",
        "adaptive.advisoryPartitionSizeInBytes": "20000",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "adaptive.coalescePartitions.enabled": "false",
    }.items():
        conf(f"spark.sql.{name}", value)
    conf("spark.sql.shuffle.partitions", "16")
    joined = joins.with_transactions(sales.repartition(8), features.transactions)
    assert "skew=true" in run_plan(joined)
    assert joined.count() == expected == ROWS


def test_repeated_holidays_are_hashed_before_they_are_ordered(spark):
    holidays = stage(
        spark.range(30_000).select(
            F.lit(day("2024-01-01")).alias("date"),
            (F.col("id") % 3).cast("string").alias("type"),
            F.lit("l").alias("locale"),
            F.lit("n").alias("locale_name"),
        ),
        "holidays",
    )
    daily = signals.holidays_daily(holidays)
    assert rows(daily) == [(day("2024-01-01"), "0", "l", "n")]
    text = plan(daily)
    assert text.rindex("HashAggregate") > text.rindex("Sort [")


def test_rollups_combine_before_the_shuffle(tables, spark):
    text = plan(star.by_day(tables[0]))
    assert text.count("HashAggregate") == 2
    weather = ", ".join(f"{n} double" for n in schemas.WEATHER_MEASURES.values())
    hourly = spark.createDataFrame([], f"date date, city_norm string, {weather}")
    assert "partial_avg" in plan(signals.weather_daily(hourly))


def test_history_takes_one_shuffle_of_the_size_asked_for(spark, tables):
    text = plan(windows.with_history(tables[0], partitions=6))
    assert [shuffle[-3:] for shuffle in _shuffles(text)] == [", 6"]
    assert len(re.findall(r"\+- Sort \[", text)) == 1


def test_stage_reports_its_own_size(spark):
    """The lookup is far smaller than what it was computed from."""
    lookup = spark.range(100_000).groupBy((F.col("id") % 5).alias("k")).count()
    stored = stage(lookup, "lookup")
    size = stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 10_000
    assert rows(stored) == rows(lookup)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert first.startswith(run_folder(spark) + "/x-") and first != second
    assert run_folder(spark).startswith(shared_folder(spark) + "/")


def test_shared_folder_is_in_the_warehouse_unless_named():
    class Session:
        class conf:
            settings = {"spark.sql.warehouse.dir": "hdfs://name/warehouse"}
            get = classmethod(lambda cls, name, default=None: cls.settings.get(name, default))

    assert shared_folder(Session) == "hdfs://name/warehouse/_work"


def test_stored_tables_go_when_the_application_cleans_up(spark):
    stage(spark.range(3), "left")
    folder = run_folder(spark).removeprefix("file:")
    assert os.listdir(folder)
    clean(spark)
    assert not os.path.exists(folder)
    clean(spark)


def test_recommended_conf():
    terabytes = recommended_conf(10 * 1024**4, cores=4000)
    assert int(terabytes["spark.sql.shuffle.partitions"]) == 10 * 1024**4 // PARTITION_BYTES
    assert recommended_conf(1, cores=16)["spark.sql.shuffle.partitions"] == "16"


def test_apply_conf(spark, conf):
    for name in recommended_conf(1, 1):
        conf(name, spark.conf.get(name))
    apply_conf(spark, 50 * PARTITION_BYTES)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "50"


def test_even_files_for_a_table_that_keeps_little(spark, tmp_path):
    from shelfcast.sinks import write_table

    kept = spark.range(0, 40_000, 1, 40).filter("id % 100 = 0")
    for name, rebalance, files in (("plain", False, 40), ("even", True, 1)):
        write_table(kept, str(tmp_path / name), rebalance)
        assert len(list((tmp_path / name).glob("*.parquet"))) == files
        assert spark.read.parquet(str(tmp_path / name)).count() == 400


def test_month_with_most_rows_is_split_on_write(spark, conf, tmp_path):
    from shelfcast.sinks import write_by_month

    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    data = spark.range(20_000).select(
        F.rand(1).alias("y"),
        F.lit(2024).alias("year"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 12 + 1).cast("int").alias("month"),
    )
    path = tmp_path / "t"
    write_by_month(data.repartition(6), str(path))
    files = {m: len(list((path / "year=2024" / f"month={m}").glob("*.parquet"))) for m in (1, 2)}
    assert files[1] > files[2] >= 1
    assert spark.read.parquet(str(path)).count() == 20_000


def test_baseline_forecasts_join_no_signal(spark):
    """Their plan joins the items alone; the training table looks up five signals more."""
    if not os.path.isdir(TABLES_FOLDER):
        pytest.skip("no test tables")
    joins_of = [
        len(re.findall(r"\w+Join ", plan(run(name, spark, TABLES_FOLDER))))
        for name in ("baseline_forecast", "model_train")
    ]
    assert joins_of[0] <= 2 and joins_of[1] >= joins_of[0] + 5
