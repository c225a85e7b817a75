"""Text files with lines on top, as others deliver them, written by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast import schemas

#: Lines that one task sorts and writes.
ROWS_PER_TASK = 1_000_000
HEADER = ",".join([schemas.WEATHER_TIME, *schemas.WEATHER_MEASURES])
TOP = f"latitude,longitude,elevation\n-0.2,-78.5,2850.0\n\n{HEADER}"


def write_topped(lines: DataFrame, key: str, top: str, folder: str) -> None:
    """A folder per ``key`` with the lines in ``value``, each file with ``top`` above them.

    Lines are dealt over as many tasks as all of them need, so a key with most of the lines
    is not one task's work. A task writes one file per key that it holds.
    """
    tasks = lines.count() // ROWS_PER_TASK + 1
    task = F.pmod(F.xxhash64("value"), F.lit(tasks)).cast("int")
    dealt = lines.select(key, task.alias("task"), F.lit(1).alias("rank"), "value")
    tops = dealt.select(key, "task").distinct()
    tops = tops.withColumns({"rank": F.lit(0), "value": F.lit(top)})
    (
        dealt.unionByName(tops)
        .repartitionById(tasks, "task")
        .sortWithinPartitions(key, "rank")
        .select(key, "value")
        .write.partitionBy(key)
        .text(folder)
    )


def write_weather_files(
    hourly: DataFrame, folder: str, time_format: str = schemas.WEATHER_TIME_FORMAT
) -> None:
    """A folder per city, with metadata lines and a header above the readings of each file."""
    values = [
        F.coalesce(F.col(short).cast("string"), F.lit(""))
        for short in schemas.WEATHER_MEASURES.values()
    ]
    time = F.date_format("ts", time_format)
    readings = hourly.select(
        F.replace("city", F.lit("%20"), F.lit(" ")).alias("city"),
        F.concat_ws(",", time, *values).alias("value"),
    )
    write_topped(readings, "city", TOP, folder)
