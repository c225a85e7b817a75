"""Raw sales files to the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfcast import schemas
from shelfcast.operators import star
from shelfcast.operators.signals import with_date
from shelfcast.session import stage_all
from shelfcast.sinks import Release, read_table
from shelfcast.sources import Database, Intake
from shelfcast.sources.csv import fail_on, worst_rejects

TABLES = ("dim_item", "dim_store", "fact_sales")
REJECT_SHARE = 0.01


@dataclass(frozen=True)
class StarSchema:
    dim_item: DataFrame
    dim_store: DataFrame
    fact_sales: DataFrame


def star_schema(items: DataFrame, stores: DataFrame, sales: DataFrame) -> StarSchema:
    return StarSchema(
        dim_item=star.item_dimension(items),
        dim_store=star.store_dimension(stores),
        fact_sales=star.sales_fact(sales, items),
    )


def read_star(spark: SparkSession, folder: str) -> StarSchema:
    return StarSchema(*[read_table(spark, f"{folder}/{name}") for name in TABLES])


def load_star(spark: SparkSession, database: Database) -> StarSchema:
    """The star schema from a database: the fact in parts, the dimensions stored on the way.

    A database tells no sizes; stored, the dimensions have one, and joins with them move
    no sales while they are small.
    """
    dimensions = {name: database.read(spark, name) for name in ("dim_item", "dim_store")}
    fact = with_date(database.read_fact(spark, "fact_sales"))
    return StarSchema(**stage_all(dimensions), fact_sales=fact)


def run(
    spark: SparkSession,
    raw: str,
    out: str,
    database: Database | None = None,
    reject_share: float = REJECT_SHARE,
) -> StarSchema:
    """Write the three tables as parquet, then copy those to the database.

    Every raw file is scanned once. Values that do not parse are kept in
    ``ingest_quarantine`` and counted in ``ingest_rejects``, which describe the last run
    whatever came of it; above ``reject_share`` the job fails and the stored tables stay as
    they were. The fact keeps a fraction of each CSV split, so its files are evened out for
    the jobs that read it.
    """
    intake = Intake()
    items = intake.read_csv(spark, f"{raw}/items.csv", schemas.ITEMS, "items")
    stores = intake.read_csv(spark, f"{raw}/stores.csv", schemas.STORES, "stores")
    sales = intake.read_csv(spark, f"{raw}/train.csv", schemas.SALES, "sales")
    with Release(spark, out) as release:
        rejects = release.write(intake.counts().coalesce(1), "ingest_rejects")
        worst = worst_rejects(rejects, reject_share)
        release.write(intake.bad_values(), "ingest_quarantine")
        release.publish("ingest_rejects", "ingest_quarantine")
        fail_on(worst)
        release.write(star.item_dimension(items), "dim_item")
        release.write(star.store_dimension(stores), "dim_store")
        release.write(star.sales_fact(sales, items), "fact_sales", rebalance=True)
        release.publish(*TABLES)
    stored = read_star(spark, out)
    if database:
        for name in TABLES:
            database.overwrite(getattr(stored, name), name)
    return stored
