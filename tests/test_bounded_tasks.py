"""Reducers hold a bounded number of rows, however large the tables are."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan

from shelfcast import session
from shelfcast.operators.tails import AS_OF, tails_before
from shelfcast.plans import incremental
from shelfcast.testkit.tables import TABLES
from shelfcast.testkit.views import Inputs


@pytest.fixture
def unset(spark):
    names = (session.ADVISORY_SIZE, session.INITIAL_PARTITIONS)
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.unset(name)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_inputs_size_reducers_by_rows(spark, tmp_path, unset, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    lines = spark.range(3000).selectExpr(
        "id div 4 as l_orderkey", "id as l_partkey", "id % 50 as l_suppkey",
        "1.0d as l_quantity", "0.0d as l_discount", "'N' as l_returnflag", "'O' as l_linestatus",
        "timestamp_ntz'2013-01-02 00:00:00' as l_shipdate",
    )
    orders = spark.range(750).selectExpr(
        "id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "1.0d as o_totalprice",
        "timestamp_ntz'2013-01-01 00:00:00' as o_orderdate",
    )
    for name, rows in (("lineitem", lines), ("orders", orders)):
        schema = spark.createDataFrame([], TABLES[name]).schema
        rows.select(schema.names).write.parquet(str(tmp_path / f"{name}.parquet"))
    inputs = Inputs(spark, str(tmp_path))
    assert spark.conf.get(session.INITIAL_PARTITIONS) == "30"
    assert int(spark.conf.get(session.ADVISORY_SIZE)) == session.TASK_BYTES
    found = inputs.transactions.groupBy().sum("transactions").first()[0]
    assert found == 3000  # four lines of an order are at four stores


def test_smaller_tasks_are_left_alone(spark, unset, monkeypatch):
    spark.conf.set(session.ADVISORY_SIZE, "1MB")
    spark.conf.set(session.INITIAL_PARTITIONS, "500")
    session.bounded_tasks(spark, 20 * session.TASK_ROWS)
    assert spark.conf.get(session.ADVISORY_SIZE) == "1MB"
    assert spark.conf.get(session.INITIAL_PARTITIONS) == "500"


def _sold(spark):
    return spark.range(3000, numPartitions=1).selectExpr(
        "date'2016-01-01' + int(id % 100) as date", "id % 50 as store_id", "id % 60 as item_id",
        "double(id) as unit_sales",
    )


def test_tails_are_repeated_behind_their_only_shuffle(spark):
    months = [dt.date(2016, month, 1) for month in (2, 3, 4)]
    text = plan(tails_before(_sold(spark), months))
    assert text.count("Exchange") == 1
    assert text.index("Generate") < text.index("Exchange")  # parents come first
    below = text[text.index("Exchange") :]
    assert "Sort" not in below and "Window" not in below


def test_tails_are_written_by_tasks_of_bounded_rows(spark, conf, tmp_path):
    conf(session.ADVISORY_SIZE, "2KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    sold = _sold(spark).selectExpr("*", f"date'2016-04-01' as {AS_OF}")
    incremental._store_tails(sold, str(tmp_path))
    folder = tmp_path / incremental.TAILS / f"{AS_OF}=2016-04-01"
    assert len(list(folder.glob("*.parquet"))) > 1
    assert spark.read.parquet(str(folder)).count() == 3000
