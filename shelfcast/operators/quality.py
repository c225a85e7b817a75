"""Profiles, counts and guards."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def weather_profile(weather: DataFrame) -> DataFrame:
    """One row: first and last date, number of cities."""
    return weather.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.countDistinct("city_norm").alias("num_cities"),
    )


def rows_per(df: DataFrame, key: str) -> DataFrame:
    """Row count per value of a key, in key order."""
    return df.groupBy(key).count().orderBy(key)


def distinct_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: how many values the column has, NULL being one of them."""
    return df.select(column).distinct().agg(F.count("*").alias(name))


def stage_row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named stage with its row count, in a single job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def sample_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a stated order: a top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def sales_rejects(sales: DataFrame, measure: str = "unit_sales") -> DataFrame:
    """One row: the records that the returns filter drops, by reason."""
    amount = F.col(measure)
    return sales.agg(
        F.count_if(amount < 0).alias("returns"),
        F.count_if(amount.isNull()).alias("unknown"),
        F.count_if(F.isnan(amount)).alias("not_a_number"),
        F.count_if(F.col("date").isNull()).alias("undated"),
    )


def null_rates(df: DataFrame) -> DataFrame:
    """One row: per column, the share of rows where it is NULL."""
    return df.agg(
        *[F.avg(F.col(f"`{name}`").isNull().cast("int")).alias(name) for name in df.columns]
    )


def _canonical(name: str, kind: T.DataType, digits: int) -> Column:
    """A value as text that does not depend on the engine; fractions with a fixed scale."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value.cast(f"decimal(38,{digits})")
    return F.coalesce(value.cast("string"), F.lit("\x00"))


def fingerprint(df: DataFrame, digits: int = 6) -> DataFrame:
    """One row: ``row_count`` and the sum of the rows' hashes, whatever their order.

    Columns are taken by name. 60 bits of an MD5 per row are added up as whole numbers, so
    equal tables have equal sums, repeated rows count each time, and partial sums merge. Sums
    of up to 10**20 rows fit. Fractions are compared to ``digits`` digits.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    text = F.concat_ws("\x1f", *[_canonical(name, kinds[name], digits) for name in sorted(kinds)])
    hashed = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)").cast("string")
    return df.agg(F.count("*").alias("row_count"), total.alias("fingerprint"))


def fingerprints(tables: Mapping[str, DataFrame], digits: int = 6) -> DataFrame:
    """``stage, row_count, fingerprint`` of named tables, in a single job."""
    return reduce(
        DataFrame.unionAll,
        [
            fingerprint(df, digits).select(F.lit(name).alias("stage"), "row_count", "fingerprint")
            for name, df in tables.items()
        ],
    )


def assert_same_rows(left: DataFrame, right: DataFrame, digits: int = 6) -> None:
    """Fail unless both tables hold the same rows, in any order."""
    found = fingerprints({"left": left, "right": right}, digits).drop("stage").distinct()
    if sorted(left.columns) != sorted(right.columns) or found.count() != 1:
        raise ValueError("the tables do not hold the same rows")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys on more than one row, with the row count. A NULL key joins nothing."""
    return df.dropna(subset=list(keys)).groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows, after a job that fails if a key repeats."""
    found = repeated_keys(df, *keys).take(1)
    if found:
        raise ValueError(f"key {keys} repeats: {found[0].asDict()}")
    return df
