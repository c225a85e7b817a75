"""Hourly weather CSVs: metadata lines on top, the city only in the file name."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import city_from_path, city_key
from shelfcast.session import stage
from shelfcast.sources.intake import LINE

_PLACE = ("block", "line")


def _time(text: Column) -> Column:
    """Wall-clock time, or NULL for anything that is no date with an hour part.

    A cast takes ISO dates and times in all their lengths, and is several times cheaper
    than a parse with a pattern. A zone is ignored.
    """
    time = F.trim(text)
    return F.when(F.contains(time, F.lit(":")), time.try_cast("timestamp_ntz"))


def _first_column() -> Column:
    return F.trim(F.replace(F.split("value", ",", 2)[0], F.lit('"')))


def _line_time() -> Column:
    return _time(_first_column())


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines: ``file``, the place in it (``block, line``) and the text ``value``.

    Lines of one block are numbered in order.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.rtrim("value", F.lit("\r")).alias("value"),
        )
        .where(F.trim("value") != "")
    )


def _below_header(lines: DataFrame) -> DataFrame:
    """Lines with their file's ``header`` and whether they are ``lost``: not data, below it.

    Without a header there is nothing that tells metadata from data that went wrong, so any
    line that is not data counts as lost.
    """
    text = F.trim("value")
    header = F.lower(_first_column()) == schemas.WEATHER_TIME
    place = F.struct(*_PLACE)
    heads = lines.groupBy("file").agg(F.min(F.when(header, F.struct(place, text))).alias("head"))
    heads = stage(heads.select("file", "head.*").toDF("file", "at", "header"), "headers")
    below = F.col("at").isNull() | (place > F.col("at"))
    return lines.join(heads, "file").withColumn("lost", _line_time().isNull() & below)


def file_profile(lines: DataFrame) -> DataFrame:
    """Per file: its header line (NULL if none), and how many lines are what.

    ``lost_lines`` stand below the header and are not data; in a file without a header, all
    that are not data. Only one small row per file is kept from the first pass to the second.
    """
    return (
        _below_header(lines)
        .groupBy("file", "header")
        .agg(
            F.count("*").alias("lines"),
            F.count(_line_time()).alias("data_lines"),
            F.count_if("lost").alias("lost_lines"),
        )
    )


def _fields(columns: list[str]) -> Column:
    return F.from_csv("value", ", ".join(f"`{name}` string" for name in columns))


def bad_values(lines: DataFrame, columns: list[str]) -> DataFrame:
    """``input, file, column, text`` of every lost line and every measure that does not parse."""
    lost = _below_header(lines).where("lost").select("file", F.lit(LINE).alias("column"), "value")
    data = lines.where(_line_time().isNotNull()).select("file", _fields(columns).alias("row"))
    measures = [
        F.struct(F.lit(name).alias("column"), F.trim(F.col("row")[name]).alias("text"))
        for name in schemas.WEATHER_MEASURES
    ]
    each = data.select("file", F.inline(F.array(*measures)))
    each = each.where((F.col("text") != "") & F.col("text").try_cast("double").isNull())
    return lost.toDF("file", "column", "text").unionAll(each).select(
        F.lit("weather").alias("input"), "file", "column", "text"
    )


def reject_counts(bad: DataFrame, profile: DataFrame) -> DataFrame:
    """``input, column, rejected, rows`` of the measures that have bad values."""
    rows = profile.agg(F.sum("data_lines")).first()[0] or 0
    counts = bad.where(F.col("column") != LINE).groupBy("input", "column")
    return counts.agg(F.count("*").alias("rejected")).withColumn("rows", F.lit(rows))


def header_columns(profile: DataFrame) -> list[str]:
    """Column names in file order. Every file must have a header, and the same.

    No more than two distinct headers reach the driver.
    """
    layouts = (
        profile.groupBy("header")
        .agg(F.min("file").alias("file"))
        .orderBy(F.col("header").asc_nulls_first())
        .take(2)
    )
    for layout in layouts:
        if layout.header is None:
            raise ValueError(f"no '{schemas.WEATHER_TIME}' header line in {layout.file}")
    if len(layouts) > 1:
        raise ValueError(f"different headers in {[layout.file for layout in layouts]}")
    names = [name.strip() for name in next(csv.reader([layouts[0].header]))]
    names[0] = names[0].lower()
    needed = [schemas.WEATHER_TIME, *schemas.WEATHER_MEASURES]
    missing = [name for name in needed if name not in names]
    if missing:
        raise ValueError(f"{layouts[0].file} lacks columns {missing}")
    return names


def check_lost(profile: DataFrame, share: float = 0.0) -> None:
    """Fail if a file loses more than ``share`` of its data and lost lines together."""
    below = F.col("lost_lines") + F.col("data_lines")
    worst = profile.where(F.col("lost_lines") > share * below).orderBy("file").take(3)
    if worst:
        found = [f"{row.file}: {row.lost_lines} of {row.lines}" for row in worst]
        raise ValueError(f"data lines without a time: {found}")


def hourly(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Hourly rows of the lines that start with a time.

    That drops metadata, blank and header lines on the executors, whatever the file sizes.
    """
    measures = [
        F.trim(F.col("row")[name]).try_cast("double").alias(short)
        for name, short in schemas.WEATHER_MEASURES.items()
    ]
    return (
        lines.withColumn("ts", _line_time())
        .where(F.col("ts").isNotNull())
        .withColumn("row", _fields(columns))
        .select(
            "ts",
            F.to_date("ts").alias("date"),
            city_key(city_from_path(F.col("file"))).alias("city_norm"),
            *measures,
        )
    )


def read_weather(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    lost_share: float = 0.0,
) -> DataFrame:
    """Hourly rows: ``ts, date, city_norm`` and the five measures.

    The text is read once and stored as a table; headers and lost lines are checked and
    rows are parsed from there. ``columns``, the column order, stands in for headers.
    """
    lines = stage(read_lines(spark, path), "weather-lines")
    profile = stage(file_profile(lines), "weather-profile")
    names = columns or header_columns(profile)
    check_lost(profile, lost_share)
    return hourly(lines, names)
