"""What a key sold on earlier dates, as a feature that does not leak."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import stage_all

KEYS = ("family", "store_id", "item_id")
#: How many rows of the overall mean a key's own mean is mixed with.
PRIOR_ROWS = 20.0


def encoded(key: str) -> str:
    return f"te_{key}"


def _earlier(training: DataFrame, measure: str, *keys: str) -> DataFrame:
    """Per key and date, the sum and count of the measure on earlier dates.

    Rows are rolled up to key and date first, so a key has no more rows than the calendar has
    days, whatever share of all rows it holds, and the rows of one date never see each other.
    """
    daily = training.groupBy(*keys, "date").agg(
        F.sum(measure).alias("units"), F.count(measure).alias("rows")
    )
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("date")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(
        *keys,
        "date",
        F.coalesce(F.sum("units").over(before), F.lit(0.0)).alias("units"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows"),
    )


def with_target_encoding(
    training: DataFrame,
    keys: Sequence[str] = KEYS,
    measure: str = "y",
    prior_rows: float = PRIOR_ROWS,
) -> DataFrame:
    """``training`` with ``te_<key>`` for each key.

    The mean of the key's rows on earlier dates, mixed with ``prior_rows`` rows of the mean of
    all rows on earlier dates, 0 on the first date. A key that is NULL has that overall mean.
    ``training`` should be a stored table, as every key reads three of its columns once.
    """
    parts = {key: _earlier(training, measure, key) for key in keys}
    stored = stage_all({"overall": _earlier(training, measure), **parts})
    overall = stored["overall"].select(
        "date", F.coalesce(F.try_divide("units", "rows"), F.lit(0.0)).alias("_prior")
    )
    result = training.join(overall, "date", "left")
    for key in keys:
        own = stored[key].withColumnsRenamed({"units": "_units", "rows": "_rows"})
        mixed = (F.coalesce("_units", F.lit(0.0)) + F.col("_prior") * prior_rows) / (
            F.coalesce("_rows", F.lit(0)) + prior_rows
        )
        result = result.join(own, [key, "date"], "left").withColumn(encoded(key), mixed)
        result = result.drop("_units", "_rows")
    return result.select(*training.columns, *map(encoded, keys))
