"""JDBC tables, as source and sink."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Write settings for large tables.
BATCH_SIZE = 5000
WRITE_CONNECTIONS = 8
ISOLATION = "NONE"
CHECK = "connection_check"

# How a fact table is split for reading, by store number.
FACT_KEY = "store_id"
FACT_FIRST, FACT_LAST = 1, 54
FACT_PARTITIONS = 8


@dataclass(frozen=True)
class Database:
    """Where the tables are. Credentials come from the caller or environment."""

    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    schema: str | None = None
    fetch_size: int = 10_000
    fact_key: str = FACT_KEY
    fact_bounds: tuple[int, int] = (FACT_FIRST, FACT_LAST)
    fact_partitions: int = FACT_PARTITIONS
    fact_predicates: tuple[str, ...] = ()
    write_connections: int = WRITE_CONNECTIONS

    @classmethod
    def from_env(
        cls, prefix: str = "SHELFCAST_JDBC_", env: Mapping[str, str] = os.environ, **more
    ) -> Database:
        """Settings from ``<prefix>URL``, ``DRIVER``, ``USER``, ``PASSWORD``, ``SCHEMA``."""
        return cls(
            url=env[prefix + "URL"],
            driver=env[prefix + "DRIVER"],
            user=env.get(prefix + "USER", ""),
            password=env.get(prefix + "PASSWORD", ""),
            schema=env.get(prefix + "SCHEMA"),
            **more,
        )

    def table(self, name: str) -> str:
        """Full table name; a name that already has a schema is left alone."""
        return f"{self.schema}.{name}" if self.schema and "." not in name else name

    def options(self, name: str) -> dict[str, str]:
        login = {"user": self.user, "password": self.password}
        return {
            "url": self.url,
            "driver": self.driver,
            "dbtable": self.table(name),
            **{key: value for key, value in login.items() if value},
        }

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A small table, over one connection."""
        return spark.read.format("jdbc").options(**self._reading(name)).load()

    def read_fact(self, spark: SparkSession, name: str) -> DataFrame:
        """A large table, by ``fact_predicates`` if there are any, or else by ranges."""
        if self.fact_predicates:
            return self.read_where(spark, name, list(self.fact_predicates))
        return self.read_split(spark, name)

    def read_split(self, spark: SparkSession, name: str) -> DataFrame:
        """A large table, split by ranges of an integer column.

        The bounds only set the strides: values outside them are still read, by the
        first and last range, and NULLs go to the first. So they should span the keys
        there are; where rows crowd on a few keys, predicates split better.
        """
        lower, upper = self.fact_bounds
        return (
            spark.read.format("jdbc")
            .options(**self._reading(name))
            .options(
                partitionColumn=self.fact_key,
                lowerBound=str(lower),
                upperBound=str(upper),
                numPartitions=str(self.fact_partitions),
            )
            .load()
        )

    def read_where(self, spark: SparkSession, name: str, predicates: list[str]) -> DataFrame:
        """A large table, one partition per predicate.

        For a table whose rows crowd on a few stores: give ranges of equal size,
        for example by date within the large stores. The predicates must be
        disjoint and together cover the table, NULLs included.
        """
        options = self._reading(name)
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)

    def overwrite(self, df: DataFrame, name: str, transactions: bool = True) -> None:
        """Replace a table, over a number of connections a database can bear.

        Without transactions the writes are faster, but a failed job can leave
        some rows behind.
        """
        isolation = {} if transactions else {"isolationLevel": ISOLATION}
        df.write.format("jdbc").options(
            **self.options(name),
            batchsize=str(BATCH_SIZE),
            numPartitions=str(self.write_connections),
            **isolation,
        ).mode("overwrite").save()

    def check(self, spark: SparkSession) -> None:
        """Fail unless a one-row table can be written."""
        self.overwrite(spark.createDataFrame([("shelfcast", 1)], "name string, value int"), CHECK)

    def _reading(self, name: str) -> dict[str, str]:
        return {**self.options(name), "fetchsize": str(self.fetch_size)}
