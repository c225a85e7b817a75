"""CSV scans with a declared contract instead of an inferring pass."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with header, every column as text. Reads one header line up front.

    A file whose header differs from that line fails the scan.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def parsed(value: Column, dtype: T.DataType) -> Column:
    """A value as a type, or NULL. Whole numbers, yes and no may be written ``1.0``."""
    number = value.try_cast("double")
    if isinstance(dtype, T.IntegralType):
        whole = F.when(number == F.floor(number), number).try_cast(dtype)
        return F.coalesce(value.try_cast(dtype), whole)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(
            value.try_cast("boolean"),
            F.when(number == 1, F.lit(True)).when(number == 0, F.lit(False)),
        )
    return value.try_cast(dtype)


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract's columns, found by name; text that does not parse is NULL."""
    missing = [name for name in schema.names if name not in raw.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {raw.columns}")
    return raw.select([parsed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV file, list of files or glob, as the contract's columns.

    Columns beyond the contract are never parsed.
    """
    return typed(read_csv_text(spark, path), schema)


def _rejected(schema: T.StructType) -> list[Column]:
    """Per contract column, how many values do not parse."""
    return [
        F.count_if(
            F.col(f.name).isNotNull() & parsed(F.col(f.name), f.dataType).isNull()
        ).alias(f.name)
        for f in schema.fields
    ]


def count_rejects(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per contract column, how many values do not parse."""
    return raw.agg(*_rejected(schema))


class RejectCounts:
    """What the scans of a job could not parse, counted while the job writes its tables."""

    def __init__(self) -> None:
        self._observed: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def read_csv(
        self, spark: SparkSession, path: str | list[str], schema: T.StructType, name: str
    ) -> DataFrame:
        """``read_csv``, whose first run also counts."""
        raw, seen = read_csv_text(spark, path), Observation(name)
        typed(raw, schema)
        counts = [F.count("*").alias("_rows"), *_rejected(schema)]
        self._observed[name] = (seen, raw, counts)
        return typed(raw.observe(seen, *counts), schema)

    @staticmethod
    def _counts(seen: Observation, raw: DataFrame, counts: list[Column]) -> dict[str, int]:
        try:
            return seen.get
        except Py4JJavaError:  # nothing could join these rows, so Spark did not read them
            return raw.agg(*counts).first().asDict()

    def table(self, spark: SparkSession) -> DataFrame:
        """``input, column, rejected, rows``, once everything has run."""
        found = [
            (name, column, count, counts["_rows"])
            for name, observed in self._observed.items()
            for counts in [self._counts(*observed)]
            for column, count in counts.items()
            if column != "_rows"
        ]
        schema = "input string, column string, rejected long, rows long"
        return spark.createDataFrame(found, schema).coalesce(1)


def worst_rejects(rejects: DataFrame, share: float) -> list[dict]:
    """The columns of which more than ``share`` of the values did not parse."""
    worst = rejects.where(F.col("rejected") > share * F.col("rows")).collect()
    return [row.asDict() for row in worst]


def fail_on(worst: list[dict]) -> None:
    if worst:
        raise ValueError(f"values that do not parse: {worst}")


def check_rejects(rejects: DataFrame, share: float) -> None:
    """Fail if more than ``share`` of a column's values did not parse."""
    fail_on(worst_rejects(rejects, share))
