"""String expressions, JVM-side only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words in a city name, how Spark names part files,
# and what stands around the city in the name of a file or folder.
WORD_GAP = r"(?:%20|\s)+"
PART_FILE = "part-0"
BEFORE_CITY = "city="
AFTER_CITY = ".csv"


def city_key(city: Column) -> Column:
    """Join key for a city name.

    A run of blanks and ``%20`` counts as one space. Other percent escapes,
    accents and no-break spaces are part of the name and stay.
    """
    return F.lower(F.trim(F.regexp_replace(city, WORD_GAP, " ")))


def city_from_path(path: Column) -> Column:
    """City named by a weather file.

    The name is the file stem (``.../Quito.csv``). Where Spark wrote the files,
    it is the folder that holds the part files (``.../Quito.csv/part-00000``, or
    ``.../city=Quito/part-00000``). Plain string functions, as this runs per line
    and a pattern over the path costs more than reading the line.
    """
    file = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    name = F.when(file.startswith(PART_FILE), folder).otherwise(file)
    start = F.when(name.startswith(BEFORE_CITY), len(BEFORE_CITY)).otherwise(0)
    end = F.when(name.endswith(AFTER_CITY), len(AFTER_CITY)).otherwise(0)
    return F.substring(name, start + 1, F.length(name) - start - end)
