"""Left joins of the signals onto sales rows.

None of them carries a broadcast hint: the signals are stored tables (see
``session.stage``), so ``spark.sql.autoBroadcastJoinThreshold`` is checked
against their measured size. One that outgrows the threshold is joined by
shuffling, where adaptive execution splits the hot keys of the sales side.
A signal that repeats a key multiplies the sales rows it matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast import schemas
from shelfcast.operators.filters import perishable


def with_item(fact: DataFrame, dim_item: DataFrame) -> DataFrame:
    """Sales of perishable items with the item's attributes."""
    return fact.join(perishable(dim_item), "item_id")


def with_city(fact: DataFrame, store_cities: DataFrame) -> DataFrame:
    return fact.join(store_cities, "store_id", "left")


def with_national(fact: DataFrame, *signals: DataFrame) -> DataFrame:
    """Signals keyed by date."""
    for signal in signals:
        fact = fact.join(signal, "date", "left")
    return fact


def with_transactions(fact: DataFrame, transactions: DataFrame) -> DataFrame:
    return fact.join(transactions, ["date", "store_id"], "left")


def with_weather(fact: DataFrame, weather: DataFrame) -> DataFrame:
    return fact.join(weather, ["date", "city_norm"], "left")


def with_signals(
    fact: DataFrame,
    store_cities: DataFrame,
    oil: DataFrame,
    transactions: DataFrame,
    holidays: DataFrame,
    weather: DataFrame,
) -> DataFrame:
    """All five signals, in one chain without a shuffle while they are small.

    Transactions grow with the number of stores, so they are the first to need a
    shuffle and come first, while the rows are narrow.
    """
    fact = with_city(with_transactions(fact, transactions), store_cities)
    return with_weather(with_national(fact, oil, holidays), weather)


def fill_signals(df: DataFrame) -> DataFrame:
    """Zero for a signal that is missing; weather and promotions stay unknown."""
    return df.fillna({n: zero for n, zero in schemas.SIGNAL_DEFAULTS.items() if n in df.columns})
