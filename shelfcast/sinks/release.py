"""Tables that appear together, once they have been checked.

A job writes its tables to a folder of its run next to the stored ones, checks them there
and moves them into place with one rename each. If anything fails before that, the stored
tables are as they were; if a rename fails, those done before it are taken back. Renames
move no data and are atomic per table on HDFS and local disks. A reader that is still
working on the table that was replaced may fail, it never sees half of a new one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sinks.parquet import read_table, write_by_month, write_table

RUNS = "_runs"


class Release:
    """Use as a context: what is not published when it ends is dropped."""

    def __init__(self, spark: SparkSession, out: str) -> None:
        self.spark, self.out = spark, out.rstrip("/")
        self.folder = f"{self.out}/{RUNS}/{uuid.uuid4().hex}"
        path = self._path(self.out)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def __enter__(self) -> Release:
        return self

    def __exit__(self, *_) -> None:
        self._files.delete(self._path(self.folder), True)
        runs = self._path(f"{self.out}/{RUNS}")
        if self._files.exists(runs) and not self._files.listStatus(runs):
            self._files.delete(runs, False)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, df: DataFrame, name: str, rebalance: bool = False) -> DataFrame:
        """Write a table of this run; returns a reader of it, good until it is published."""
        write_table(df, self.path(name), rebalance)
        return read_table(self.spark, self.path(name))

    def write_by_month(self, df: DataFrame, name: str) -> DataFrame:
        write_by_month(df, self.path(name))
        return read_table(self.spark, self.path(name))

    def _rename(self, source: str, target: str) -> None:
        here, there = self._path(source), self._path(target)
        if not self._files.exists(here) or not self._files.rename(here, there):
            raise OSError(f"cannot move {source} to {target}")

    def publish(self, *names: str) -> None:
        """Put tables of this run in the place of the stored ones of the same name."""
        done: list[tuple[str, str]] = []
        self._files.mkdirs(self._path(f"{self.folder}/old"))
        try:
            for name in names:
                moves = [(self.path(name), f"{self.out}/{name}")]
                if self._files.exists(self._path(f"{self.out}/{name}")):
                    moves.insert(0, (f"{self.out}/{name}", f"{self.folder}/old/{name}"))
                for source, target in moves:
                    self._rename(source, target)
                    done.append((source, target))
        except Exception:
            for source, target in reversed(done):
                self._rename(target, source)
            raise
