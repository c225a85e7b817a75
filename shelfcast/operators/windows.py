"""History features of a series, by row.

All expressions are over the same partitions in the same order, so together they
cost one shuffle by series and one sort. A series must hold one row per date
(``star.by_day`` makes it so): ties would leave the order, and so the result,
open, and it is what keeps any one series, and so any one sort group, no longer
than the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import schemas

ITEM_SERIES = ("store_id", "item_id")


def _history(series: Sequence[str]):
    return Window.partitionBy(*series).orderBy("date")


def with_lags(
    fact: DataFrame,
    series: Sequence[str] = ITEM_SERIES,
    measure: str = "unit_sales",
    lags: Sequence[int] = schemas.LAGS,
) -> DataFrame:
    """The measure 1, 7, 14 and 28 rows back, whatever the gaps between dates."""
    rows = _history(series)
    return fact.withColumns({f"lag_{n}": F.lag(measure, n).over(rows) for n in lags})


def with_trailing_means(
    fact: DataFrame,
    series: Sequence[str] = ITEM_SERIES,
    measure: str = "unit_sales",
    lengths: Sequence[int] = schemas.TRAILING_DAYS,
) -> DataFrame:
    """Mean of the 7, 14 and 28 rows before this one; of fewer at the start.

    Spark recomputes a sliding frame for every row, 49 additions for these three.
    So only one week is summed that way, and the longer means add up the sums
    found 7, 14 and 21 rows back. Nothing is ever subtracted, so the sums are as
    accurate as those of the full frames. Lengths that are no multiple of the
    shortest one get a sliding frame of their own.
    """
    rows = _history(series)
    block = min(lengths)
    others = [n for n in lengths if n % block]
    plain = {f"roll_mean_{n}": F.avg(measure).over(rows.rowsBetween(-n, -1)) for n in others}
    multiples = [n for n in lengths if n % block == 0]
    blocks = range(max(multiples) // block)
    week = rows.rowsBetween(-block, -1)
    sums, counts = [f"_sum_{i}" for i in blocks], [f"_count_{i}" for i in blocks]

    result = fact.withColumns(
        {
            sums[0]: F.coalesce(F.sum(measure).over(week), F.lit(0.0)),
            counts[0]: F.count(measure).over(week),
        }
    )
    result = result.withColumns(
        {
            name[i]: F.lag(name[0], i * block, 0).over(rows)
            for name in (sums, counts)
            for i in blocks[1:]
        }
    )
    means = [
        F.try_divide(
            sum((F.col(c) for c in reversed(sums[: n // block])), F.lit(0.0)),
            sum((F.col(c) for c in counts[: n // block]), F.lit(0)),
        ).alias(f"roll_mean_{n}")
        for n in multiples
    ]
    result = result.withColumns(plain).select("*", *means)
    return result.select(*fact.columns, *[f"roll_mean_{n}" for n in lengths])


def with_history(
    fact: DataFrame,
    series: Sequence[str] = ITEM_SERIES,
    measure: str = "unit_sales",
    partitions: int | None = None,
    verify: bool = False,
) -> DataFrame:
    """Lags and trailing means.

    ``partitions`` fixes the number of shuffle partitions by series. Left out,
    adaptive execution sizes them. ``verify`` fails on a series that repeats a
    date; it looks at the row before, which costs no shuffle.
    """
    if partitions:
        fact = fact.repartition(partitions, *series)
    history = with_trailing_means(with_lags(fact, series, measure), series, measure)
    if not verify:
        return history
    again = F.lag("date").over(_history(series)) == F.col("date")
    fail = F.raise_error(F.lit("a series repeats a date")).cast("boolean")
    checked = history.withColumn("_again", again)
    # not deterministic, so that no later filter is tried first
    sound = F.when(F.col("_again"), fail).otherwise(F.spark_partition_id() >= 0)
    return checked.where(sound).drop("_again")
