"""Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONTH_KEYS = ("year", "month")


def write_table(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Replace a parquet table.

    ``rebalance`` evens out the file sizes, at the price of a shuffle. It is for
    tables that keep little of each input split and are read many times.
    """
    if rebalance:
        df = df.hint("rebalance")
    df.write.mode("overwrite").parquet(path)


def write_by_month(df: DataFrame, path: str, rebalance: bool = True) -> None:
    """Replace a parquet table laid out in ``year=/month=`` folders.

    Without a rebalance every task adds a file to every month it meets: at tens
    of thousands of tasks, millions of small files. The rebalance hint groups
    rows by month, and adaptive execution splits the months that are too large
    for one task and merges the ones that are too small.
    """
    if rebalance:
        df = df.hint("rebalance", *MONTH_KEYS)
    df.write.mode("overwrite").partitionBy(*MONTH_KEYS).parquet(path)


def replace_months(df: DataFrame, path: str) -> None:
    """Replace the months that ``df`` has rows of, and leave the other folders alone."""
    df = df.hint("rebalance", *MONTH_KEYS)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*MONTH_KEYS).parquet(path)


def drop_months(spark: SparkSession, path: str, first: dt.date, kept: DataFrame) -> None:
    """Remove the folders of the month of ``first`` and later ones that ``kept`` has no rows of.

    The folders are listed; no file of the table is opened.
    """
    left = {tuple(row) for row in kept.select(*MONTH_KEYS).distinct().collect()}
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(pattern):
        folder = status.getPath()
        year, month = (
            int(part.getName().split("=")[1]) for part in (folder.getParent(), folder)
        )
        if (year, month) >= (first.year, first.month) and (year, month) not in left:
            files.delete(folder, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table; giving the schema saves the job that looks it up."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
