"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas


def without_returns(sales: DataFrame, measure: str = "unit_sales") -> DataFrame:
    """Sales with a known amount of zero or more: no returns, NULLs or NaNs."""
    amount = F.col(measure)
    return sales.filter((amount >= 0) & ~F.isnan(amount))


def is_set(df: DataFrame, column: str) -> Column:
    """Whether a yes/no column says yes, by the type it happens to have.

    Booleans and numbers are compared as they are, so the test reaches the file
    or database scan. Text may spell it 1, true, t, yes or y, in any case.
    """
    dtype, value = df.schema[column].dataType, F.col(column)
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.NumericType):
        return value == 1
    return value.try_cast("boolean") | (value.try_cast("double") == 1)


def perishable(items: DataFrame, column: str = "perishable") -> DataFrame:
    """Items, or rows that carry the item's attributes, marked perishable."""
    return items.filter(is_set(items, column))


def warmed_up(features: DataFrame) -> DataFrame:
    """Rows with a full history behind them. Apply after the windows, not before."""
    return features.filter(F.col(f"lag_{schemas.WARMUP}").isNotNull())
