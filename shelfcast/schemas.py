"""Input contracts and output column orders.

Everything here is a fixed value: column names, types and orders that other
systems read, so they are stated once and used everywhere else by name.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# The columns each raw file must carry (a file may carry more).
ITEMS = _schema(
    item_nbr=T.IntegerType(),
    family=T.StringType(),
    **{"class": T.IntegerType()},
    perishable=T.StringType(),
)
STORES = _schema(
    store_nbr=T.IntegerType(),
    city=T.StringType(),
    state=T.StringType(),
    type=T.StringType(),
    cluster=T.IntegerType(),
)
SALES = _schema(
    date=T.DateType(),
    store_nbr=T.IntegerType(),
    item_nbr=T.IntegerType(),
    unit_sales=T.DoubleType(),
    onpromotion=T.BooleanType(),
)
OIL = _schema(date=T.DateType(), dcoilwtico=T.DoubleType())
TRANSACTIONS = _schema(
    date=T.DateType(), store_nbr=T.IntegerType(), transactions=T.IntegerType()
)
HOLIDAYS = _schema(
    date=T.DateType(),
    type=T.StringType(),
    locale=T.StringType(),
    locale_name=T.StringType(),
)

# Hourly weather header names (units included) and our short names.
WEATHER_TIME = "time"
WEATHER_TIME_FORMAT = "yyyy-MM-dd H:mm"
WEATHER_MEASURES = {
    "temperature_2m (°C)": "temp_c",
    "precipitation (mm)": "precip_mm",
    "rain (mm)": "rain_mm",
    "relative_humidity_2m (%)": "rh_pct",
    "apparent_temperature (°C)": "apparent_c",
}

# Daily weather measures, as (output, aggregate, hourly column).
WEATHER_ROLLUP = [
    ("temp_avg_c", "avg", "temp_c"),
    ("temp_min_c", "min", "temp_c"),
    ("temp_max_c", "max", "temp_c"),
    ("precip_total_mm", "sum", "precip_mm"),
    ("rain_total_mm", "sum", "rain_mm"),
    ("humidity_avg_pct", "avg", "rh_pct"),
    ("apparent_avg_c", "avg", "apparent_c"),
]
DAILY_WEATHER = [name for name, _, _ in WEATHER_ROLLUP]

# Star schema.
DIM_ITEM = ["item_id", "family", "class", "perishable"]
DIM_STORE = ["store_id", "city", "state", "store_type", "cluster"]
FACT_SALES = ["date", "store_id", "item_id", "unit_sales", "onpromotion"]

# Window lengths, calendar columns and the signals filled when missing.
LAGS = (1, 7, 14, 28)
TRAILING_DAYS = (7, 14, 28)
WARMUP = 28
CALENDAR = [
    "year",
    "month",
    "day",
    "weekofyear",
    "dow",
    "is_weekend",
    "is_month_start",
    "is_month_end",
]
SIGNAL_DEFAULTS = {"oil_price": 0.0, "transactions": 0, "is_holiday": 0}

# Output column orders.
ENRICHED_SALES = [
    "date",
    "city_norm",
    "store_id",
    "item_id",
    "unit_sales",
    "onpromotion",
    "oil_price",
    "transactions",
    "is_holiday",
    *DAILY_WEATHER,
]
MODEL_BASE = [
    "date",
    "city_norm",
    "store_id",
    "item_id",
    "unit_sales",
    "onpromotion",
    "family",
    "class",
    "perishable",
    "oil_price",
    "transactions",
    "holiday_type",
    "locale",
    "locale_name",
    *DAILY_WEATHER,
]
MODEL_TRAIN = [
    "date",
    "store_id",
    "item_id",
    "y",
    "onpromotion",
    "family",
    "oil_price",
    "transactions",
    "is_holiday",
    *DAILY_WEATHER,
    *[name for name in CALENDAR if name != "day"],
    *[f"lag_{n}" for n in LAGS],
    *[f"roll_mean_{n}" for n in TRAILING_DAYS],
]
