from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("shelfcast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df) -> list[tuple]:
    """Rows in a fixed order, NULLs included."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    """The physical plan as text; the final one if the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    """The physical plan after adaptive execution."""
    df.collect()
    return plan(df)
