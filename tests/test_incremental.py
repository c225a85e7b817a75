"""The training table by updates against the table built at once."""

import datetime as dt
import os
import random

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import tails
from shelfcast.plans import incremental, training
from shelfcast.plans.features import FeatureTables
from shelfcast.sinks import read_table

SERIES = (
    "date date, store_id int, item_id int, family string, unit_sales double, onpromotion boolean"
)


def _sales(seed=1):
    """Five months: a dense series, sparse ones, one that ends early and one that starts late."""
    draw = random.Random(seed)
    days = [day("2016-01-01") + dt.timedelta(days=i) for i in range(150)]
    shares = {(1, 1): days, (1, 2): days[::3], (2, 1): days[:50], (2, 2): days[110:], (3, 1): days[7::9]}
    return [
        (date, store, item, f"F{item}", draw.randrange(1, 99) / 8, draw.choice([True, False, None]))
        for (store, item), dates in shares.items()
        for date in dates
        if not (store == 1 and date.month == 3 and item == 2)
    ]


@pytest.fixture(scope="module")
def lookups(spark):
    days = [day("2016-01-01") + dt.timedelta(days=i) for i in range(150)]
    weather = ", ".join(f"{name} double" for name in schemas.DAILY_WEATHER)
    dim_store = spark.createDataFrame([(1, "Quito"), (2, "Loja")], "store_id int, city string")
    return dim_store, FeatureTables(
        spark.createDataFrame([(d, d.day / 4) for d in days[::2]], "date date, oil_price double"),
        spark.createDataFrame(
            [(d, 1, d.day) for d in days[::3]], "date date, store_id int, transactions int"
        ),
        spark.createDataFrame(
            [(d, "a", "b", "c") for d in days[::11]],
            "date date, holiday_type string, locale string, locale_name string",
        ),
        spark.createDataFrame(
            [(d, "quito", *[d.day / 2] * 7) for d in days], f"date date, city_norm string, {weather}"
        ),
    )


def _whole(spark, data, lookups):
    return rows(training.training_table(spark.createDataFrame(data, SERIES), *lookups))


def _stored(table):
    return rows(table.select(schemas.MODEL_TRAIN))


def test_updates_give_the_table_of_all_sales(spark, lookups, tmp_path):
    out, data = str(tmp_path), _sales()
    frame = spark.createDataFrame(data, SERIES)
    table = incremental.build(spark, frame.where("date < '2016-03-10'"), *lookups, out)
    assert _stored(table) == _whole(spark, [r for r in data if r[0] < day("2016-03-10")], lookups)
    old = {
        name: os.stat(f"{out}/model_train/year=2016/month={name}").st_mtime_ns for name in (1, 2)
    }
    # the rest of March, then April, then all of May, each with what came before it
    for first, upto in (("2016-03-15", "2016-04-01"), ("2016-04-01", "2016-05-01")):
        some = frame.where(F.col("date") < upto)
        incremental.extend(spark, some, *lookups, out, day(first))
    table = incremental.extend(spark, frame, *lookups, out, day("2016-05-02"))
    assert _stored(table) == _whole(spark, data, lookups)
    assert old == {
        name: os.stat(f"{out}/model_train/year=2016/month={name}").st_mtime_ns for name in (1, 2)
    }


def test_late_and_corrected_sales(spark, lookups, tmp_path):
    out, data = str(tmp_path), _sales(2)
    incremental.build(spark, spark.createDataFrame(data, SERIES), *lookups, out)
    late = [r for r in data if r[0] != day("2016-04-20")]
    late += [(day("2016-04-02"), 3, 1, "F1", 7.0, True)]
    frame = spark.createDataFrame(late, SERIES)
    for _ in range(2):  # an update that is repeated changes nothing
        table = incremental.extend(spark, frame, *lookups, out, day("2016-04-02"))
        assert _stored(table) == _whole(spark, late, lookups)
    with pytest.raises(ValueError, match="no tails are kept for 2016-01-01"):
        incremental.extend(spark, frame, *lookups, out, day("2016-01-31"))


def test_months_without_sales(spark, lookups, tmp_path):
    out, data = str(tmp_path), _sales(3)
    incremental.build(spark, spark.createDataFrame(data, SERIES), *lookups, out)
    # all of May is taken back, and comes again after a month in which nothing came
    none = [r for r in data if r[0].month < 5]
    table = incremental.extend(spark, spark.createDataFrame(none, SERIES), *lookups, out, day("2016-05-01"))
    assert _stored(table) == _whole(spark, none, lookups)
    assert not os.path.exists(f"{out}/model_train/year=2016/month=5")
    later = none + [(day("2016-07-09"), 1, 1, "F1", 3.0, None)]
    table = incremental.extend(spark, spark.createDataFrame(later, SERIES), *lookups, out, day("2016-07-01"))
    assert _stored(table) == _whole(spark, later, lookups)


def test_build_without_sales(spark, lookups, tmp_path):
    none, out = spark.createDataFrame([], SERIES), str(tmp_path)
    assert incremental.build(spark, none, *lookups, out).count() == 0
    with pytest.raises(ValueError, match="no tails are kept"):
        incremental.extend(spark, none, *lookups, out, day("2016-01-01"))
    few = spark.createDataFrame(_sales()[:20], SERIES)
    assert incremental.build(spark, few, *lookups, out).count() == 0
    more = spark.createDataFrame(_sales(), SERIES)
    table = incremental.extend(spark, more, *lookups, out, day("2016-01-20"))
    assert _stored(table) == _whole(spark, _sales(), lookups)


def test_tails_are_the_last_rows_before_each_month(spark):
    data = _sales(4)
    months = [day("2016-03-01"), day("2016-06-01")]
    found = tails.tails_before(spark.createDataFrame(data, SERIES), months, length=5)
    want = []
    for month in months:
        for key in {r[1:3] for r in data}:
            mine = sorted((r for r in data if r[1:3] == key and r[0] < month), key=lambda r: r[0])
            want += [(*r, month) for r in mine[-5:]]
    assert rows(found) == sorted(want, key=repr)


def test_an_update_reads_no_old_month(spark, lookups, tmp_path):
    out, data = str(tmp_path), _sales()
    frame = spark.createDataFrame(data, SERIES)
    incremental.build(spark, frame.where("date < '2016-05-01'"), *lookups, out)
    # no stored month can be opened any more
    for month in (1, 2, 3, 4):
        folder = f"model_train/year=2016/month={month}"
        for name in os.listdir(f"{out}/{folder}"):
            if name.endswith(".parquet"):
                with open(f"{out}/{folder}/{name}", "wb") as file:
                    file.write(b"not parquet")
                crc = f"{out}/{folder}/.{name}.crc"
                if os.path.exists(crc):
                    os.remove(crc)
    new = frame.where("date >= '2016-05-01'")
    incremental.extend(spark, new, *lookups, out, day("2016-05-01"))
    may = read_table(spark, f"{out}/model_train/year=2016/month=5")
    assert may.count() == sum(r[0].month == 5 for r in _whole(spark, data, lookups))
