"""Batch jobs: ``python -m shelfcast JOB --raw FOLDER --out FOLDER``."""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession

from shelfcast.operators import quality
from shelfcast.plans import (
    audit,
    boosting,
    evaluation,
    features,
    incremental,
    ingest,
    training,
)
from shelfcast.session import apply_conf, clean, stage
from shelfcast.sinks import read_table, write_table
from shelfcast.sources import Database

JOBS = (
    "check-database",
    "ingest",
    "weather",
    "features",
    "enrich",
    "base",
    "train",
    "forecast",
    "evaluate",
    "check-weather",
    "audit",
)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfcast", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--raw", help="folder of the raw files")
    parser.add_argument("--out", help="folder of the parquet tables")
    parser.add_argument(
        "--database", action="store_true", help="also use the database in SHELFCAST_JDBC_*"
    )
    parser.add_argument("--daily", action="store_true", help="sales hold one row per item and day")
    parser.add_argument(
        "--monthly", action="store_true", help="train: also keep what later updates need"
    )
    parser.add_argument(
        "--since", type=dt.date.fromisoformat, help="train: update from this date's month on"
    )
    parser.add_argument("--partitions", type=int, help="shuffle partitions for the history")
    parser.add_argument("--columns", help="weather columns in order, for files without a header")
    parser.add_argument("--reject-share", type=float, help="share of values that may fail to parse")
    parser.add_argument("--db-key", help="whole-number column that splits large tables")
    parser.add_argument("--db-bounds", type=int, nargs=2, help="first and last key")
    parser.add_argument("--db-partitions", type=int, help="parts to read large tables in")
    parser.add_argument(
        "--db-predicate", action="append", help="condition of one part; repeat to cover the table"
    )
    parser.add_argument("--db-connections", type=int, help="connections to write over")
    parser.add_argument("--shuffle-gb", type=float, help="size of the largest shuffle, for settings")
    options = parser.parse_args(arguments)
    if options.job in ("ingest", "weather", "features") and not options.raw:
        parser.error(f"{options.job} needs --raw")
    if options.job != "check-database" and not options.out:
        parser.error(f"{options.job} needs --out")

    spark = SparkSession.builder.appName(f"shelfcast-{options.job}").getOrCreate()
    apply_conf(spark, int((options.shuffle_gb or 0) * 1024**3))
    wants_database = options.database or options.job == "check-database"
    database = Database.from_env(**_database_options(options)) if wants_database else None
    try:
        _run(options, spark, database)
    finally:
        clean(spark)


def _database_options(options: argparse.Namespace) -> dict:
    given = {
        "fact_key": options.db_key,
        "fact_bounds": options.db_bounds and tuple(options.db_bounds),
        "fact_partitions": options.db_partitions,
        "fact_predicates": options.db_predicate and tuple(options.db_predicate),
        "write_connections": options.db_connections,
    }
    return {name: value for name, value in given.items() if value is not None}


def _run(options: argparse.Namespace, spark: SparkSession, database: Database | None) -> None:
    raw, out = options.raw, options.out
    share = {} if options.reject_share is None else {"reject_share": options.reject_share}

    if options.job == "check-database":
        database.check(spark)
    elif options.job == "ingest":
        ingest.run(spark, raw, out, database, **share)
    elif options.job == "weather":
        columns = options.columns.split(",") if options.columns else None
        features.run_weather(spark, raw, out, columns, options.reject_share or 0.0)
    elif options.job == "features":
        features.run(spark, raw, out, database, **share)
    elif options.job == "check-weather":
        weather = read_table(spark, f"{out}/weather_daily")
        weather.printSchema()
        quality.weather_profile(weather).show(truncate=False)
        write_table(quality.rows_per(weather, "city_norm"), f"{out}/weather_rows_per_city")
        read_table(spark, f"{out}/weather_rows_per_city").show(50, truncate=False)
    elif options.job == "forecast":
        for name in boosting.run(spark, out):
            table = read_table(spark, f"{out}/{name}")
            print(f"{name}, {table.count()} rows stored, the first of them:")
            table.show(100, truncate=False)
    else:
        tables = ingest.load_star(spark, database) if database else ingest.read_star(spark, out)
        signals = (
            features.load_features(spark, database)
            if database
            else features.read_features(spark, out)
        )
        if options.job == "audit":
            if database:  # counted, joined and sampled: read it from the database once
                tables = replace(tables, fact_sales=stage(tables.fact_sales, "fact"))
        else:
            audit.check_unique(tables, signals)
        if options.job == "enrich":
            training.run_enrich(spark, tables, signals, out, database)
        elif options.job == "train":
            if options.monthly or options.since:
                incremental.run(
                    spark, tables, signals, out, options.since, options.daily, options.partitions
                )
            else:
                training.run_training(
                    spark, tables, signals, out, options.daily, options.partitions
                )
        elif options.job == "base":
            training.run_model_base(spark, tables, signals, out)
        elif options.job == "evaluate":
            for name, table in evaluation.run(spark, tables, out, options.daily).items():
                print(name)
                table.show(20)
        else:
            enriched = training.enriched_sales(tables.fact_sales, tables.dim_store, signals)
            audit.row_counts(tables, signals, enriched=enriched).show(truncate=False)
            audit.fan_out(tables, signals).show(truncate=False)
            audit.fingerprints(tables, signals).show(truncate=False)
            if database:
                copies = ingest.read_star(spark, out), features.read_features(spark, out)
                audit.check_copies(audit.stages(*copies), audit.stages(tables, signals))
            quality.distinct_values(tables.fact_sales, "store_id", "num_stores").show()
            for table in (*audit.stages(tables, signals).values(), enriched):
                table.show(5, truncate=False)


if __name__ == "__main__":
    main()
