"""Effects of factors on units within a series, each adjusted for the others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import flag
from shelfcast.operators.windows import ITEM_SERIES

#: A factor that varies by less than this share of the largest has no effect of its own.
LEAST_VARIATION = 1e-9


def within_products(
    rows: DataFrame, values: Mapping[str, Column], keys: Sequence[str] = ITEM_SERIES
) -> tuple[dict[tuple[str, str], float], int]:
    """Sums of products of deviations from the series' means, and the number of rows.

    One aggregation by series takes sums and products with partial sums, so no series need be
    gathered and no mean joined back; the products of the deviations follow from those, and a
    second aggregation adds up the series.
    """
    names = list(values)
    pairs = list(combinations_with_replacement(names, 2))
    known = rows.select(*keys, *[value.cast("double").alias(f"v{i}") for i, value in enumerate(values.values())])
    known = known.dropna(subset=[f"v{i}" for i in range(len(names))])
    place = {name: f"v{i}" for i, name in enumerate(names)}
    series = known.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(column).alias(f"s_{column}") for column in place.values()],
        *[
            F.sum(F.col(place[a]) * F.col(place[b])).alias(f"p_{place[a]}_{place[b]}")
            for a, b in pairs
        ],
    )
    totals = series.agg(
        F.sum("n").alias("n"),
        *[
            F.sum(
                F.col(f"p_{place[a]}_{place[b]}")
                - F.col(f"s_{place[a]}") * F.col(f"s_{place[b]}") / F.col("n")
            ).alias(f"p_{place[a]}_{place[b]}")
            for a, b in pairs
        ],
    ).first()
    found = {(a, b): totals[f"p_{place[a]}_{place[b]}"] or 0.0 for a, b in pairs}
    return found, totals["n"] or 0


def adjusted_effects(
    rows: DataFrame,
    factors: Mapping[str, Column] | Sequence[str],
    measure: str = "y",
    keys: Sequence[str] = ITEM_SERIES,
) -> DataFrame:
    """``factor, effect, n``: least squares on the factors and a level of its own per series.

    A yes/no factor that is unknown counts as no; rows that lack any other value are left out.
    ``effect`` is NULL for a factor that never varies within a series, or only together with
    factors named before it.
    """
    if not isinstance(factors, Mapping):
        factors = {
            name: flag(F.col(name)) if rows.schema[name].dataType.typeName() == "boolean" else F.col(name)
            for name in factors
        }
    products, n = within_products(rows, {**factors, measure: F.col(measure)}, keys)

    def product(a: str, b: str) -> float:
        return products[a, b] if (a, b) in products else products[b, a]

    used: list[str] = []
    largest = max((product(name, name) for name in factors), default=0.0)
    for name in factors:
        # what is left of a factor once those before it are taken out
        gram = np.array([[product(a, b) for b in used] for a in used]).reshape(len(used), len(used))
        shared = np.array([product(a, name) for a in used])
        rest = product(name, name) - (shared @ np.linalg.solve(gram, shared) if used else 0.0)
        if rest > LEAST_VARIATION * max(largest, 1.0):
            used.append(name)
    gram = np.array([[product(a, b) for b in used] for a in used]).reshape(len(used), len(used))
    target = np.array([product(a, measure) for a in used])
    solved = dict(zip(used, np.linalg.solve(gram, target).tolist())) if used else {}
    found = [(name, solved.get(name), n) for name in factors]
    return rows.sparkSession.createDataFrame(found, "factor string, effect double, n long")
