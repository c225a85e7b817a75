"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 128 * 1024**2
#: Of a shuffle of narrow rows, as compressed and as rows.
TASK_BYTES = 8 * 1024**2
TASK_ROWS = 1_000_000
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Settings that help at any size.
ALWAYS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def recommended_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves ``shuffle_bytes``.

    The initial shuffle partition count is what adaptive execution coalesces
    from, so it is sized for the data with the cluster's core count as a floor.
    """
    partitions = max(cores, math.ceil(shuffle_bytes / PARTITION_BYTES))
    return ALWAYS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def bounded_tasks(spark: SparkSession, rows: int) -> None:
    """Reducers of about ``TASK_ROWS`` of the largest table, however many rows there are.

    Adaptive execution merges partitions up to a size in compressed bytes, which may be many
    millions of narrow rows; sorts and hash maps hold them at several times that size. A
    smaller size for merged partitions and as many partitions as the rows need bound both.
    """
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    found = spark.conf.get(ADVISORY_SIZE, None)
    if not found or size(found) > TASK_BYTES:
        spark.conf.set(ADVISORY_SIZE, str(TASK_BYTES))
    held = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    needed = math.ceil(rows / TASK_ROWS)
    if needed > int(held):
        spark.conf.set(INITIAL_PARTITIONS, str(needed))


def apply_conf(spark: SparkSession, shuffle_bytes: int | None = None) -> None:
    """``ALWAYS``, or ``recommended_conf`` for a running session and the cores it has."""
    settings = ALWAYS
    if shuffle_bytes:
        settings = recommended_conf(shuffle_bytes, spark.sparkContext.defaultParallelism)
    for name, value in settings.items():
        spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/shelfcast-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Remove all that this application stored on the way. No lazy plan may need it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the run folder that nothing has written to yet."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of it.

    The reader's size is the size of its files, so the planner's broadcast
    threshold decides on a measured size instead of on an estimate inherited
    from the tables ``df`` was aggregated from. Losing an executor afterwards
    costs nothing: the table is on shared storage, where it stays until ``clean``,
    as a lazy plan may still read from it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``stage`` several tables at a time, as none of them fills a cluster."""
    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(zip(tables, pool.map(stage, tables.values(), tables)))
