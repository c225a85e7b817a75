"""The training table kept up to date month by month.

Beside ``model_train`` stands ``series_tails``: the last 28 rows of every series before each
of the latest months (``as_of``). Sales that arrive, or change, from some month on are put
into the table by computing those months alone: their rows follow the tails of the first of
them, and only their folders are replaced. Months before are neither read nor written.

An update touches every month from the first changed one on, as later rows look back on it.
It is refused if the tails of that month are no longer kept; then the table is built anew.
Either way the result is that of building the table from all sales.

Order of an update: new months and new tails are stored in the run folder, where the repeated
date check runs; then the folders of the months are replaced, then the tails. An update that
is cut off in between is repeated with the same first month and gives the same table. Sales
too few for a history give an empty table, which can be extended like any other; without any
sales no tails are kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.filters import warmed_up
from shelfcast.operators.tails import AS_OF, history_after, tails_before
from shelfcast.operators.windows import ITEM_SERIES
from shelfcast.plans.features import FeatureTables
from shelfcast.plans.ingest import StarSchema
from shelfcast.plans.training import finished, perishable_series, training_table
from shelfcast.session import stage
from shelfcast.sinks import read_table
from shelfcast.sinks.parquet import drop_months, replace_months, write_by_month

TABLE, TAILS = "model_train", "series_tails"
#: Tails are kept for the month after the last sales and so many months up to it.
KEPT_MONTHS = 3


def month_of(date: dt.date, later: int = 0) -> dt.date:
    """The first day of a date's month, or of a month ``later`` (or earlier, below zero)."""
    number = date.year * 12 + date.month - 1 + later
    return dt.date(number // 12, number % 12 + 1, 1)


def _months_to_keep(last: dt.date, kept: int) -> list[dt.date]:
    return [month_of(last, later) for later in range(1 - kept, 2)]


def _last_date(series: DataFrame) -> dt.date | None:
    return series.agg(F.max("date")).first()[0]


def _with_marks(tails: DataFrame, months: list[dt.date]) -> DataFrame:
    """``tails`` and a row without a date for each month, which may have no rows before it."""
    fields = [f for f in tails.schema.fields if f.name != AS_OF]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    marks = tails.sparkSession.createDataFrame([(month,) for month in months], f"{AS_OF} date")
    return tails.unionByName(marks.select(*none, AS_OF))


def _store_tails(tails: DataFrame, out: str) -> None:
    """Replace all tails, with those that are already stored in the run folder.

    Dealt by series, so that a task sorts a reducer's rows and not those of a whole split of
    files.
    """
    tails = tails.hint("rebalance", AS_OF, *ITEM_SERIES)
    tails.write.mode("overwrite").partitionBy(AS_OF).parquet(f"{out}/{TAILS}")


def build(
    spark: SparkSession,
    series: DataFrame,
    dim_store: DataFrame,
    features: FeatureTables,
    out: str,
    kept: int = KEPT_MONTHS,
    partitions: int | None = None,
    verify: bool = False,
) -> DataFrame:
    """Training table and tails from all sales, one row per series and date."""
    table = training_table(series, dim_store, features, partitions, verify)
    write_by_month(table, f"{out}/{TABLE}")
    last = _last_date(series)
    months = _months_to_keep(last, kept) if last else []
    # without sales there are no months, and no tails
    tails = tails_before(series, months) if months else series.withColumn(AS_OF, F.col("date"))
    _store_tails(stage(_with_marks(tails, months), "tails"), out)
    return read_table(spark, f"{out}/{TABLE}", table.schema)


def _tails_for(tails: DataFrame, first: dt.date) -> DataFrame:
    """The tails of a month, or of the one after the last sales if that is earlier."""
    months = sorted(row[0] for row in tails.select(AS_OF).distinct().collect())
    fitting = [month for month in months if month <= first]
    if not fitting or (fitting[-1] != first and fitting[-1] != months[-1]):
        raise ValueError(f"no tails are kept for {first}, only for {[*map(str, months)]}")
    tails = tails.where((F.col(AS_OF) == F.lit(fitting[-1])) & F.col("date").isNotNull())
    return tails.drop(AS_OF)


def extend(
    spark: SparkSession,
    series: DataFrame,
    dim_store: DataFrame,
    features: FeatureTables,
    out: str,
    first: dt.date,
    kept: int = KEPT_MONTHS,
    partitions: int | None = None,
    verify: bool = False,
) -> DataFrame:
    """Put all sales of the month of ``first`` and of later ones into the training table.

    ``series`` may hold earlier sales as well; they are not looked at.
    """
    first = month_of(first)
    series = stage(series.where(F.col("date") >= F.lit(first)), "new-sales")
    fields = [*series.schema.fields, T.StructField(AS_OF, T.DateType())]
    stored = read_table(spark, f"{out}/{TAILS}", T.StructType(fields))
    tails = stage(_tails_for(stored, first), "tails-before")
    history = history_after(tails, series, partitions=partitions, verify=verify)
    later = FeatureTables(
        **{
            name: table.where(F.col("date") >= F.lit(first))
            for name, table in features.tables().items()
        }
    )
    months = stage(finished(warmed_up(history), dim_store, later), "new-months")

    both = tails.unionByName(series.select(tails.columns))
    last = _last_date(series) or first
    keep = [month for month in _months_to_keep(last, kept) if month >= first]
    still = stored.where(F.col(AS_OF) < F.lit(first))
    still = still.where(F.col(AS_OF) >= F.lit(month_of(last, 1 - kept)))
    renewed = _with_marks(tails_before(both, keep).select(still.columns), keep)
    renewed = stage(still.unionByName(renewed), "tails")

    replace_months(months, f"{out}/{TABLE}")
    drop_months(spark, f"{out}/{TABLE}", first, months)
    _store_tails(renewed, out)
    return read_table(spark, f"{out}/{TABLE}", months.schema)


def run(
    spark: SparkSession,
    tables: StarSchema,
    features: FeatureTables,
    out: str,
    first: dt.date | None = None,
    daily: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``build`` from all stored sales, or ``extend`` by those from ``first`` on."""
    fact = tables.fact_sales
    if first is not None:
        fact = fact.where(F.col("date") >= F.lit(month_of(first)))
    series = perishable_series(fact, tables.dim_item, daily)
    options = dict(partitions=partitions, verify=daily)
    if first is None:
        return build(spark, series, tables.dim_store, features, out, **options)
    return extend(spark, series, tables.dim_store, features, out, first, **options)

