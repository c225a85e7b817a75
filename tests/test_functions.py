from conftest import day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.functions import calendar_columns, city_from_path, city_key


def _apply(spark, function, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [row[0] for row in df.select(function(F.col("v"))).collect()]


def test_city_key(spark):
    cases = {
        "  El%20 Carmen\t": "el carmen",
        "Quito": "quito",
        "SANTO%20DOMINGO": "santo domingo",
        "a%20%20b \n c": "a b c",
        "Bah%C3%ADa": "bah%c3%ada",
        "no break": "no break",
        "%2%200": "%2 0",
        "%20": "",
        "": "",
        None: None,
    }
    assert _apply(spark, city_key, list(cases)) == list(cases.values())


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text("ab%20 \t", max_size=12), min_size=1, max_size=30))
def test_city_key_equals_stepwise_decoding(spark, names):
    def stepwise(name):
        decoded = " ".join(part for part in name.replace("%20", " ").split())
        return decoded.lower()

    assert _apply(spark, city_key, names) == [stepwise(name) for name in names]


def test_city_from_path(spark):
    cases = {
        "file:///raw/weather/El%20Carmen.csv": "El%20Carmen",
        "Quito.csv": "Quito",
        "s3://b/weather/Quito.csv/part-00000-ab.csv": "Quito",
        "file:/w/city=Port%20view/part-00003-ab-c000.txt": "Port%20view",
        "file:/w/St.csv.csv": "St.csv",
    }
    assert _apply(spark, city_from_path, list(cases)) == list(cases.values())


def test_calendar(spark):
    dates = ["2021-01-01", "2024-12-30", "2024-06-01", "2024-06-02", "2023-02-28", "2024-02-27"]
    df = spark.createDataFrame([(day(d),) for d in dates] + [(None,)], "date date")
    found = {
        str(row.date): row.asDict()
        for row in df.withColumns(calendar_columns(F.col("date"))).collect()
    }
    assert found["2021-01-01"]["weekofyear"] == 53
    assert (found["2024-12-30"]["weekofyear"], found["2024-12-30"]["year"]) == (1, 2024)
    assert (found["2024-06-01"]["dow"], found["2024-06-01"]["is_weekend"]) == (7, 1)
    assert (found["2024-06-02"]["dow"], found["2024-06-02"]["is_weekend"]) == (1, 1)
    assert found["2024-06-01"]["is_month_start"] == 1
    assert found["2024-06-02"]["is_month_start"] == 0
    assert found["2023-02-28"]["is_month_end"] == 1
    assert found["2024-02-27"]["is_month_end"] == 0
    unknown = found["None"]
    assert unknown["year"] is None
    assert [unknown[f] for f in ("is_weekend", "is_month_start", "is_month_end")] == [0, 0, 0]
