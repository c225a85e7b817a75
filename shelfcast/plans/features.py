"""Daily feature tables: oil, transactions, holidays and city weather."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfcast import schemas
from shelfcast.operators import signals
from shelfcast.session import stage, stage_all
from shelfcast.sinks import Release, read_table
from shelfcast.sources import Database, Intake, check_rejects, weather
from shelfcast.sources.csv import fail_on, worst_rejects

# Stored table names, by field of ``FeatureTables``.
TABLES = {
    "oil": "feat_oil_daily",
    "transactions": "feat_transactions_daily",
    "holidays": "feat_holidays_daily",
    "weather": "feat_weather_daily_city",
}
REJECT_SHARE = 0.01


@dataclass(frozen=True)
class FeatureTables:
    oil: DataFrame
    transactions: DataFrame
    holidays: DataFrame
    weather: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {field: getattr(self, field) for field in TABLES}

    def staged(self) -> FeatureTables:
        """The same tables, each computed once and stored."""
        return FeatureTables(**stage_all(self.tables()))


def feature_tables(
    oil: DataFrame, transactions: DataFrame, holidays: DataFrame, weather: DataFrame
) -> FeatureTables:
    """From raw oil, transactions and holidays, and daily weather."""
    return FeatureTables(
        oil=signals.oil_daily(oil),
        transactions=signals.transactions_daily(transactions),
        holidays=signals.holidays_daily(holidays),
        weather=signals.with_city_key(weather),
    )


def read_features(spark: SparkSession, folder: str) -> FeatureTables:
    return _normalised(
        {field: read_table(spark, f"{folder}/{name}") for field, name in TABLES.items()}
    )


def _normalised(tables: dict[str, DataFrame]) -> FeatureTables:
    """With city keys as the joins need them, so that checks see those too."""
    return FeatureTables(**tables | {"weather": signals.with_city_key(tables["weather"])})


def load_features(spark: SparkSession, database: Database) -> FeatureTables:
    """From a database, stored once on the way so that joins know the sizes."""
    read = {field: database.read for field in TABLES} | {"transactions": database.read_fact}
    return _normalised(
        {field: signals.with_date(read[field](spark, name)) for field, name in TABLES.items()}
    ).staged()


def run_weather(
    spark: SparkSession,
    raw: str,
    out: str,
    columns: list[str] | None = None,
    lost_share: float = 0.0,
) -> DataFrame:
    """Hourly weather files to a daily table by city.

    What each file holds, lost lines included, is stored as ``weather_files``, lost lines and
    values that do not parse as ``weather_quarantine``; both describe the last run, whatever
    came of it. A file that loses more than ``lost_share`` of its lines fails the job, as do
    more bad values in a column than that and ``REJECT_SHARE``; the stored daily table then
    stays as it was. The files' ``columns`` need only be given if they have no header.
    """
    lines = stage(weather.read_lines(spark, f"{raw}/*.csv"), "weather-lines")
    with Release(spark, out) as release:
        profile = stage(weather.file_profile(lines).coalesce(1), "weather-profile")
        names = columns or weather.header_columns(profile)
        bad = stage(weather.bad_values(lines, names), "weather-bad")
        release.write(profile, "weather_files")
        release.write(bad, "weather_quarantine")
        release.publish("weather_files", "weather_quarantine")
        weather.check_lost(profile, lost_share)
        counts = weather.reject_counts(bad, profile)
        check_rejects(counts, max(lost_share, REJECT_SHARE))
        release.write(signals.weather_daily(weather.hourly(lines, names)), "weather_daily")
        release.publish("weather_daily")
    return read_table(spark, f"{out}/weather_daily")


def run(
    spark: SparkSession,
    raw: str,
    out: str,
    database: Database | None = None,
    reject_share: float = REJECT_SHARE,
) -> FeatureTables:
    """Write the four tables as parquet, then copy those to the database.

    The daily weather must be in ``out`` already, from ``run_weather``. Values that do not
    parse are kept in ``feature_quarantine``, counted in ``feature_rejects`` and fail the job
    above ``reject_share``, before any stored table is touched.
    """
    intake = Intake()
    inputs = {
        "oil": (f"{raw}/oil.csv", schemas.OIL),
        "transactions": (f"{raw}/transactions.csv", schemas.TRANSACTIONS),
        "holidays": (f"{raw}/holidays_events.csv", schemas.HOLIDAYS),
    }
    built = feature_tables(
        **{name: intake.read_csv(spark, *where, name) for name, where in inputs.items()},
        weather=read_table(spark, f"{out}/weather_daily"),
    )
    with Release(spark, out) as release:
        rejects = release.write(intake.counts().coalesce(1), "feature_rejects")
        worst = worst_rejects(rejects, reject_share)
        release.write(intake.bad_values(), "feature_quarantine")
        release.publish("feature_rejects", "feature_quarantine")
        fail_on(worst)
        for field, name in TABLES.items():
            release.write(getattr(built, field), name)
        release.publish(*TABLES.values())
    stored = read_features(spark, out)
    if database:
        for field, name in TABLES.items():
            database.overwrite(getattr(stored, field), name)
    return stored
