"""The last rows of every series before a month: all that the history of later rows needs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import windows

#: First day of the month that a tail ends before.
AS_OF = "as_of"
_NEW = "_new"


def tails_before(
    series: DataFrame,
    months: Sequence[dt.date],
    keys: Sequence[str] = windows.ITEM_SERIES,
    length: int = schemas.WARMUP,
) -> DataFrame:
    """``series`` rows that are among the last ``length`` of their series before a month.

    A row belongs to the tails of several months (``as_of``). The rows are dealt by series
    first, as narrow as they come, and repeated for their months behind that shuffle: the sort
    that ranks them then holds a reducer's rows, and not those of a whole split of files.
    """
    every = F.array(*[F.lit(month) for month in sorted(months)])
    last = Window.partitionBy(*keys, AS_OF).orderBy(F.desc("date"))
    return (
        series.repartition(*keys)
        .withColumn(AS_OF, F.explode(F.filter(every, lambda month: month > F.col("date"))))
        .withColumn("_place", F.row_number().over(last))
        .where(F.col("_place") <= length)
        .drop("_place")
    )


def history_after(
    tails: DataFrame,
    series: DataFrame,
    keys: Sequence[str] = windows.ITEM_SERIES,
    partitions: int | None = None,
    verify: bool = False,
) -> DataFrame:
    """The history of ``series``, whose rows all come after those of ``tails``.

    Lags and means look back 28 rows and no further, so they are those of the whole series.
    """
    before = tails.select(*series.columns, F.lit(False).alias(_NEW))
    rows = before.unionByName(series.withColumn(_NEW, F.lit(True)))
    history = windows.with_history(rows, keys, partitions=partitions, verify=verify)
    return history.where(_NEW).drop(_NEW)
