"""Mixing sources to target weights: raking, then sampling by calibrated probabilities.

Documents are summed to cells (source, language, topic) first. Iterative proportional
fitting then finds one factor per source, language and topic, so that the cells' tokens
times their factors meet every target: each step sums cells by one dimension and sets its
factors to target over sum. Sums are pre-aggregated, factor tables are stored between
steps, and joins with them are broadcast or split by their stored size, so neither a hot
source nor many sources gather in one task. Only one number per round reaches the driver.

A document's rate follows from the product of its three factors; it is sampled if a hash of
its id falls below that. Nothing is repeated. The size of the sample is given as tokens
(``budget``) or as a share of the corpus' tokens (``share``): rates are then held at 1, and
what a value or cell cannot give is asked of the others by their shares, so that a rare one
is taken whole and shrinks no other. With neither, rates are scaled so that the largest is 1:
all shares are exact, but the rarest cell decides on the size. All of it is built of
DataFrame functions.

Defined results: null values are the empty string. A value without a target keeps its
natural share before the shares are scaled to 1; one with target 0 is never sampled. Cells
that do not exist cannot be filled: then targets are met as nearly as ``MAX_ROUNDS`` allow;
``misses`` tells how nearly.
Rows of one id share their fate. A null text has one token. A budget beyond the tokens of all
values with a target above 0 takes all of those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

DIMENSIONS = ("source", "lang", "topic")
MAX_ROUNDS = 30
TOLERANCE = 1e-4
#: Powers of the natural shares that make the targets, unless these are given.
POWERS = {"source": 0.8, "lang": 0.8, "topic": 1.0}
#: The share of the corpus' tokens that ``mix`` samples, unless another size is given.
SHARE = 0.75
CHARS_PER_TOKEN = 4


def topic_of(text: str = "text") -> Column:
    """A coarse kind of text, for tables without a topic."""
    body = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(body, F.lit("|")), "tables")
        .when(body.rlike("[0-9]"), "figures")
        .when(F.char_length(body) < 400, "notes")
        .otherwise("prose")
    )


def tokens_of(text: str = "text") -> Column:
    size = F.ceil(F.coalesce(F.char_length(text), F.lit(0)) / CHARS_PER_TOKEN)
    return F.greatest(size, F.lit(1)).cast("long")


def _cells(docs: DataFrame) -> DataFrame:
    return docs.groupBy(*DIMENSIONS).agg(F.sum("tokens").cast("double").alias("n"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Targets ``value, share`` between the natural shares (1) and equal ones (0)."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("n").alias("n"))
    return sums.select("value", F.pow("n", F.lit(power)).alias("share"))


def _targets(cells: DataFrame, dimension: str, shares: DataFrame) -> DataFrame:
    """``value, share`` of all values there are, as shares of 1."""
    natural = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("n").alias("n"))
    total = natural.agg(F.sum("n")).first()[0] or 1.0
    asked = shares.agg(F.sum("share")).first()[0] or 1.0
    joined = natural.join(shares.select("value", F.col("share") / asked), "value", "left")
    joined = joined.toDF("value", "n", "asked")
    joined = joined.select("value", F.coalesce("asked", F.col("n") / total).alias("share"))
    whole = joined.agg(F.sum("share")).first()[0] or 1.0
    return stage(joined.select("value", (F.col("share") / whole).alias("share")), "targets")


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A table ``value, factor`` per dimension."""
    goal = {name: _targets(cells, name, targets[name]) for name in DIMENSIONS}
    factors = {
        name: goal[name].select("value", F.lit(1.0).alias("factor")) for name in DIMENSIONS
    }
    for _ in range(MAX_ROUNDS):
        before = factors[DIMENSIONS[0]]
        for name in DIMENSIONS:
            weighted = cells
            for other in DIMENSIONS:
                if other != name:
                    weighted = _times(weighted, other, factors[other])
            sums = weighted.groupBy(F.col(name).alias("value")).agg(F.sum("n").alias("n"))
            factor = F.coalesce(F.try_divide("share", "n"), F.lit(0.0)).alias("factor")
            factors[name] = stage(sums.join(goal[name], "value").select("value", factor), "factors")
        change = F.try_divide(F.col("new.factor"), F.col("old.factor")) - 1
        both = factors[DIMENSIONS[0]].alias("new").join(before.alias("old"), "value")
        if (both.agg(F.max(F.abs(change))).first()[0] or 0.0) < TOLERANCE:
            break
    return factors


def rake_held(cells: DataFrame, targets: dict[str, DataFrame], budget: float) -> DataFrame:
    """``cells`` with ``rate``, at most 1, so that ``budget`` tokens are expected.

    Rates are products of factors held at 1. A step for a dimension takes the cells at 1 from
    its goals and fits the others to what is left; it never overshoots, and ends after few.
    """
    goal = {name: _targets(cells, name, targets[name]) for name in DIMENSIONS}
    live = cells
    for name in DIMENSIONS:
        some = goal[name].where("share > 0").select(F.col("value").alias(name))
        live = live.join(some, name, "left_semi")
    live = stage(live, "live")
    budget = min(budget, live.agg(F.sum("n")).first()[0] or 0.0)
    goal = {name: _within(live, name, goal[name], budget) for name in DIMENSIONS}
    factors = {
        name: goal[name].select("value", F.lit(1.0).alias("factor"), F.lit(0.0).alias("off"))
        for name in DIMENSIONS
    }
    for _ in range(MAX_ROUNDS):
        for name in DIMENSIONS:
            factors[name] = stage(_held_step(live, name, goal[name], factors), "factors")
        missed = reduce(DataFrame.union, [factors[name].select("off") for name in DIMENSIONS])
        if (missed.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE * budget:
            break
    rates = live.withColumn("rate", F.lit(1.0))
    for name in DIMENSIONS:
        rates = _times(rates, name, factors[name], "rate")
    rates = rates.select(*DIMENSIONS, F.least("rate", F.lit(1.0)).alias("rate"))
    return cells.join(rates, list(DIMENSIONS), "left").fillna(0.0, ["rate"])


def _within(cells: DataFrame, dimension: str, shares: DataFrame, budget: float) -> DataFrame:
    """``value, share`` in tokens: ``budget`` by shares, but to no value more than it has."""
    natural = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("n").alias("n"))
    both = stage(natural.join(shares, "value"), "within")
    each = 0.0
    while True:
        full = F.col("share") * each >= F.col("n")
        sums = both.agg(
            F.sum(F.when(full, F.col("n")).otherwise(0.0)), F.sum(F.when(~full, F.col("share")))
        ).first()
        more = (budget - (sums[0] or 0.0)) / sums[1] if sums[1] else each
        if more <= each * (1 + 1e-12):
            break
        each = more
    most = F.when(full, F.col("n")).otherwise(F.col("share") * each)
    return stage(both.select("value", most.alias("share")), "targets")


def _held_step(
    cells: DataFrame, name: str, goal: DataFrame, factors: dict[str, DataFrame]
) -> DataFrame:
    """The next ``value, factor`` of a dimension, and how many tokens it was ``off`` before.

    ``n * min(1, factor * others)`` is concave in the factor, so its tangent leads to a factor
    that is not too large; where the cells at 1 already exceed the goal, none is taken as held.
    """
    own = factors[name].select(F.col("value").alias(name), F.col("factor").alias("own"))
    weighted = cells.join(own, name).withColumn("rate", F.lit(1.0))
    for other in DIMENSIONS:
        if other != name:
            weighted = _times(weighted, other, factors[other], "rate")
    held = F.col("rate") * F.col("own") >= 1
    fitted = F.col("n") * F.col("rate")
    sums = weighted.groupBy(F.col(name).alias("value")).agg(
        F.max("own").alias("own"),
        F.sum(F.when(held, F.col("n")).otherwise(0.0)).alias("held"),
        F.sum(F.when(held, 0.0).otherwise(fitted)).alias("free"),
        F.sum(fitted).alias("all"),
    )
    fit = F.when(F.col("share") < F.col("held"), F.try_divide("share", "all")).otherwise(
        F.try_divide(F.col("share") - F.col("held"), "free")
    )
    both = sums.join(goal, "value").withColumn("factor", F.coalesce(fit, "own"))
    off = F.abs(F.col("held") + F.col("own") * F.col("free") - F.col("share"))
    return both.select("value", "factor", off.alias("off"))


def _times(rows: DataFrame, dimension: str, factors: DataFrame, into: str = "n") -> DataFrame:
    factor = factors.select(F.col("value").alias(dimension), "factor")
    joined = rows.join(factor, dimension)
    return joined.withColumn(into, F.col(into) * F.col("factor")).drop("factor")


def _drawn(
    docs: DataFrame,
    powers: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    topic: Column | None = None,
    seed: int = 17,
    budget: float | None = None,
    share: float | None = None,
) -> DataFrame:
    """``_row`` (a struct of the document's own columns), ``tokens``, ``rate``, ``drawn``."""
    rows = docs.select(
        F.struct("*").alias("_row"),
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in DIMENSIONS[:2]],
        (topic_of(text) if topic is None else topic).alias("topic"),
        tokens_of(text).alias("tokens"),
    )
    cells = stage(_cells(rows), "cells")
    goal = {
        name: (targets or {}).get(name, tempered(cells, name, (powers or POWERS)[name]))
        for name in DIMENSIONS
    }
    if budget is None and share is not None:
        budget = share * (cells.agg(F.sum("n")).first()[0] or 0.0)
    if budget is None:
        factors = rake(cells, goal)
        rates = cells.withColumn("rate", F.lit(1.0))
        for name in DIMENSIONS:
            rates = _times(rates, name, factors[name], "rate")
        largest = rates.agg(F.max("rate")).first()[0] or 1.0
        rows = rows.withColumn("rate", F.lit(1.0 / largest))
        for name in DIMENSIONS:
            rows = _times(rows, name, factors[name], "rate")
    else:
        rates = stage(rake_held(cells, goal, budget).drop("n"), "rates")
        rows = rows.join(rates, list(DIMENSIONS))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(f"_row.{doc_id}")), F.lit(2**53)) / 2**53
    # rounding must not lose the rows whose rate is 1
    drawn = draw < F.col("rate") * (1 + 1e-9)
    return rows.select("_row", "tokens", "rate", drawn.alias("drawn"))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``_tokens``, ``_rate`` and ``_sampled``, which replace columns so called.

    Targets are given as tables ``value, share`` by dimension (``targets``), or else as the
    powers that their natural shares are raised to (``powers``, or ``POWERS``). The size is
    given as ``budget`` (tokens) or ``share`` (of the corpus' tokens).
    """
    added = {"_tokens": "tokens", "_rate": "rate", "_sampled": "drawn"}
    return _drawn(docs, **options).select(
        *[F.col("_row")[name].alias(name) for name in docs.columns if name not in added],
        *[F.col(column).alias(name) for name, column in added.items()],
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, with its columns. Options as for ``sampled``.

    Without a size it is ``SHARE`` of the corpus' tokens.
    """
    if options.get("budget") is None and options.get("share") is None:
        options["share"] = SHARE
    kept = _drawn(docs, **options).where("drawn")
    return kept.select(*[F.col("_row")[name].alias(name) for name in docs.columns])


def misses(
    docs: DataFrame,
    powers: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    text: str = "text",
    topic: Column | None = None,
    **options,
) -> DataFrame:
    """``dimension, value, asked, expected``: shares of tokens that targets ask and rates give.

    What is asked cannot always be given: values may exist in too few cells, or have too few
    tokens for the sample, and rounds are bounded. The largest difference tells how far off a
    sample is. Options as for ``sampled``.
    """
    drawn = sampled(docs, powers=powers, targets=targets, text=text, topic=topic, **options)
    rows = drawn.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in DIMENSIONS[:2]],
        (topic_of(text) if topic is None else topic).alias("topic"),
        F.col("_tokens").alias("tokens"),
        F.col("_rate").alias("rate"),
    )
    cells = rows.groupBy(*DIMENSIONS).agg(
        F.sum("tokens").cast("double").alias("n"),
        F.sum(F.col("tokens") * F.col("rate")).alias("given"),
    )
    cells = stage(cells, "given")
    total = cells.agg(F.sum("given")).first()[0] or 1.0
    found = []
    for name in DIMENSIONS:
        asked = (targets or {}).get(name, tempered(cells, name, (powers or POWERS)[name]))
        given = cells.groupBy(F.col(name).alias("value")).agg(F.sum("given").alias("given"))
        both = given.join(_targets(cells, name, asked), "value")
        expected = (F.col("given") / total).alias("expected")
        found.append(
            both.select(F.lit(name).alias("dimension"), "value", F.col("share").alias("asked"), expected)
        )
    return reduce(DataFrame.union, found)
