"""How much a forecast loses when one of its features is exchanged between rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that exchange values with each other, about.
BLOCK_ROWS = 100_000
BASE = "(none)"


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))


def exchanged(
    rows: DataFrame, features: Sequence[str], keys: Sequence[str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``rows`` with ``x_<feature>``: the value of the row that the feature is taken from.

    Within a block, rows are placed by the hash of their keys, and ranked for each feature by
    a hash of the feature and their keys; the value ranked n-th goes to the row in place n. So
    every value is used once, and features are exchanged apart from each other. Blocks are
    parts by hash of the keys, so none grows with the table. All features move in one shuffle
    of narrow rows. ``keys`` must tell rows apart; ``rows`` should be a stored table.
    """
    blocks = max(1, math.ceil(rows.count() / block_rows))
    own = [F.col(key) for key in keys]
    number = F.conv(F.substring(_digest(*own), 1, 8), 16, 10).cast("long")
    placed = rows.withColumn("_block", F.pmod(number, F.lit(blocks)))
    place = Window.partitionBy("_block").orderBy(_digest(*own))
    placed = placed.withColumn("_place", F.row_number().over(place))
    ranks = {
        name: F.row_number().over(
            Window.partitionBy("_block").orderBy(_digest(F.lit(name), *own))
        )
        for name in features
    }
    ranked = placed.select(
        "_block",
        *[F.col(name).cast("double").alias(f"v_{name}") for name in features],
        *[rank.alias(f"r_{name}") for name, rank in ranks.items()],
    )
    moving = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"r_{name}").alias("_place"),
            F.col(f"v_{name}").alias("value"),
        )
        for name in features
    ]
    values = ranked.select("_block", F.inline(F.array(*moving)))
    values = values.groupBy("_block", "_place").agg(
        *[
            F.max(F.when(F.col("feature") == name, F.col("value"))).alias(f"x_{name}")
            for name in features
        ]
    )
    return placed.join(values, ["_block", "_place"]).drop("_block", "_place")


def variants(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each row of ``exchanged`` as it is (``exchanged`` is "(none)") and once per feature."""
    names = F.array(F.lit(BASE), *map(F.lit, features))
    each = rows.withColumn("exchanged", F.explode(names))
    return each.withColumns(
        {
            name: F.when(F.col("exchanged") == name, F.col(f"x_{name}")).otherwise(
                F.col(name).cast("double")
            )
            for name in features
        }
    ).drop(*[f"x_{name}" for name in features])


def losses(
    forecasts: DataFrame, prediction: str = "prediction", measure: str = "y"
) -> DataFrame:
    """``feature, mae, importance``: absolute error with it exchanged, and by how much it rose.

    ``forecasts`` are predictions for ``variants``.
    """
    error = F.abs(F.col(prediction) - F.col(measure))
    mean = forecasts.groupBy(F.col("exchanged").alias("feature")).agg(F.avg(error).alias("mae"))
    # a handful of rows, one per feature
    base = mean.where(F.col("feature") == BASE).select(F.col("mae").alias("_base"))
    rows = mean.where(F.col("feature") != BASE).join(F.broadcast(base))
    return rows.select("feature", "mae", (F.col("mae") - F.col("_base")).alias("importance"))


def permutation_importance(
    rows: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    predict: Callable[[Mapping[str, Column]], Column],
    measure: str = "y",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Importance for a model that is an expression of its features; one aggregate for all."""
    moved = exchanged(rows, features, keys, block_rows)

    def error(changed: str) -> Column:
        values = {n: F.col(f"x_{n}") if n == changed else F.col(n) for n in features}
        return F.avg(F.abs(predict(values) - F.col(measure)))

    found = [
        F.struct(F.lit(name).alias("feature"), error(name).alias("mae")) for name in features
    ]
    each = moved.agg(F.array(*found).alias("found"), error(BASE).alias("_base"))
    each = each.select(F.inline("found"), "_base")
    return each.select("feature", "mae", (F.col("mae") - F.col("_base")).alias("importance"))
