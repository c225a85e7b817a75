"""Raw files scanned once: typed rows for the job, and every value that does not parse.

The scan stores the contract's columns together with the bad values of each row, so good
rows and quarantine come from one pass over the text, and a task that runs twice counts
once: what is counted is the stored table. Rows with a bad value stay, with NULL in its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import stage
from shelfcast.sources.csv import parsed, read_csv_text

#: Stands for the column where a whole line has too few or too many fields.
LINE = "(line)"
QUARANTINE = "input string, file string, column string, text string"
COUNTS = "input string, column string, rejected long, rows long"
_LINE, _FILE, _BAD = "_line", "_file", "_bad"


def _text_with_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every column as text, and the line where it has not as many fields as the header."""
    names = read_csv_text(spark, path).columns
    fields = [T.StructField(name, T.StringType()) for name in (*names, _LINE)]
    reader = spark.read.schema(T.StructType(fields)).options(
        header=True, enforceSchema=False, columnNameOfCorruptRecord=_LINE, columnPruning=False
    )
    return reader.csv(path)


def scan(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The contract's columns by name, ``_bad`` (``column, text`` of each) and their ``_file``."""
    raw = _text_with_lines(spark, path)
    missing = [name for name in schema.names if name not in raw.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {raw.columns[:-1]}")
    typed = {f.name: parsed(F.col(f.name), f.dataType) for f in schema.fields}
    values = [
        F.when(
            F.col(name).isNotNull() & value.isNull(),
            F.struct(F.lit(name).alias("column"), F.col(name).alias("text")),
        )
        for name, value in typed.items()
    ]
    line = F.struct(F.lit(LINE).alias("column"), F.col(_LINE).alias("text"))
    bad = F.array_compact(F.array(*values, F.when(F.col(_LINE).isNotNull(), line)))
    rows = raw.select(
        *[value.alias(name) for name, value in typed.items()],
        F.when(F.size(bad) > 0, bad).alias(_BAD),
        F.col("_metadata.file_path").alias(_FILE),
    )
    return rows.withColumn(_FILE, F.when(F.col(_BAD).isNotNull(), F.col(_FILE)))


class Intake:
    """The raw files of a job, by name."""

    def __init__(self) -> None:
        self._stored: dict[str, tuple[DataFrame, list[str]]] = {}

    def read_csv(
        self, spark: SparkSession, path: str | list[str], schema: T.StructType, name: str
    ) -> DataFrame:
        """``sources.read_csv``'s rows, from the stored scan."""
        stored = stage(scan(spark, path, schema), name)
        self._stored[name] = (stored, [*schema.names, LINE])
        return stored.select(schema.names)

    def bad_values(self) -> DataFrame:
        """``input, file, column, text`` of every value that did not parse."""
        each = [
            stored.where(F.col(_BAD).isNotNull()).select(
                F.lit(name).alias("input"), F.col(_FILE).alias("file"), F.inline(_BAD)
            )
            for name, (stored, _) in self._stored.items()
        ]
        return reduce(DataFrame.unionAll, each)

    def counts(self) -> DataFrame:
        """``input, column, rejected, rows``; one pass over each stored scan's bad values."""
        each = []
        for name, (stored, columns) in self._stored.items():
            sums = [
                F.struct(
                    F.lit(column).alias("column"),
                    F.count_if(F.exists(_BAD, lambda one: one["column"] == column)).alias("rejected"),
                )
                for column in columns
            ]
            found = stored.agg(F.array(*sums).alias("sums"), F.count("*").alias("rows"))
            each.append(
                found.select(F.lit(name).alias("input"), F.inline("sums"), "rows")
            )
        return reduce(DataFrame.unionAll, each)
