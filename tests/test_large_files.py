"""Queries that write text files, at sizes where a group of lines needs several files."""

from __future__ import annotations

import datetime as dt

import pytest

from shelfcast.sources import read_weather
from shelfcast.testkit import files, queries


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_TASK", 20)


class Sold:
    """What ``csv_quarantine`` takes from the inputs."""

    def __init__(self, spark):
        self.spark = spark
        self.sales = spark.range(90).selectExpr(
            "date'2013-01-01' as date",
            "3 * id as store_nbr",
            "1 + 10 * id as item_nbr",
            "double(id) as unit_sales",
            "if(id % 2 = 0, 'True', 'perhaps') as onpromotion",
        )


@pytest.mark.parametrize("cities", [("Port%20A", "Port%20B"), ("Port%20A", None)])
def test_every_file_of_a_city_has_one_header(spark, tmp_path, small_tasks, cities):
    start = dt.datetime(2013, 1, 1)
    made = [
        (start + dt.timedelta(hours=n), cities[n % 2], float(n), 1.0, 2.0, 3.0, None)
        for n in range(300)
    ]
    names = "ts timestamp_ntz, city string, temp_c double, precip_mm double, rain_mm double, "
    hourly = spark.createDataFrame(made, names + "rh_pct double, apparent_c double")
    files.write_weather_files(hourly, str(tmp_path / "w"))
    written = list((tmp_path / "w").glob("*/*.txt"))
    assert len(written) > 10
    assert {file.read_text(encoding="utf-8").count(files.TOP) for file in written} == {1}
    read = read_weather(spark, str(tmp_path / "w"))
    assert sorted(row.temp_c for row in read.collect()) == [float(n) for n in range(300)]


def test_bad_values_come_from_files_of_bounded_size(spark, monkeypatch, small_tasks):
    seen, write = [], queries.write_topped
    monkeypatch.setattr(
        queries, "write_topped", lambda *args: [seen.append(args[-1]), write(*args)]
    )
    found = queries.csv_quarantine(Sold(spark)).groupBy("file", "column").count().collect()
    per_file = spark.read.text(f"{seen[0]}/*/*.txt").groupBy("_metadata.file_path").count()
    sizes = [row["count"] for row in per_file.collect()]
    assert len(sizes) > 3 and max(sizes) < 60
    told = {(row.file, row.column): row["count"] for row in found}
    # stores that are multiples of 4 say "maybe", the other odd rows "perhaps"
    assert told == {(0, "onpromotion"): 68}
