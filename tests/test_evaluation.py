"""Encodings, backtests, intervals, effects, smoothing and fingerprints against plain versions."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from conftest import day, plan, rows
from pyspark.sql import functions as F

from shelfcast.operators import (
    backtest,
    effects,
    encoding,
    importance,
    quality,
    sketches,
    smoothing,
    windows,
)

START = day("2024-01-01")


def _days(n):
    return [START + dt.timedelta(days=i) for i in range(n)]


# --- target encoding ------------------------------------------------------------------


def _training(seed=1, n=400):
    draw = random.Random(seed)
    return [
        (
            draw.choice(_days(20)),
            draw.choice(["A", "B", None]),
            draw.choice([1, 1, 1, 2]),
            draw.choice([None, 0.0, draw.randrange(100) / 4]),
        )
        for _ in range(n)
    ]


TRAINING = "date date, family string, store_id int, y double"


def test_encoding_is_the_smoothed_mean_of_earlier_dates(spark):
    data = _training()
    found = encoding.with_target_encoding(
        spark.createDataFrame(data, TRAINING), ("family", "store_id"), prior_rows=3.0
    )
    want = []
    for row in data:
        known = [r for r in data if r[0] < row[0] and r[3] is not None]
        prior = statistics.fmean(r[3] for r in known) if known else 0.0
        told = []
        for place in (1, 2):
            own = [r[3] for r in known if r[place] == row[place] and row[place] is not None]
            told.append((sum(own) + 3.0 * prior) / (len(own) + 3.0))
        want.append((*row, *told))
    assert found.columns[-2:] == ["te_family", "te_store_id"]
    for mine, other in zip(rows(found), sorted(want, key=repr), strict=True):
        assert mine[:4] == other[:4] and mine[4:] == pytest.approx(other[4:])


def test_encoding_sees_nothing_of_its_date_or_later(spark):
    data = _training(2)
    cut = _days(20)[10]
    changed = [(*r[:3], 1e6 if r[0] >= cut else r[3]) for r in data]
    before = []
    for table in (data, changed):
        found = encoding.with_target_encoding(spark.createDataFrame(table, TRAINING), ("family",))
        before.append(rows(found.where(F.col("date") <= F.lit(cut)).select("date", "family", "te_family")))
    assert before[0] == before[1]


def test_hot_key_is_rolled_up_before_the_window(spark):
    hot = spark.range(30_000).select(
        F.date_add(F.lit(START), (F.col("id") % 20).cast("int")).alias("date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("family"),
        F.lit(1.0).alias("y"),
    )
    daily = encoding._earlier(hot, "y", "family")
    assert daily.where("family = 'hot'").count() == 20
    assert plan(daily).index("Window") < plan(daily).index("HashAggregate")


# --- backtest -------------------------------------------------------------------------


def _series(seed=3):
    draw = random.Random(seed)
    lengths = {(1, 1): range(120), (1, 2): range(0, 120, 2), (2, 1): range(80, 120), (2, 2): range(95)}
    return [
        (START + dt.timedelta(days=i), store, item, draw.randrange(50) / 2)
        for (store, item), places in lengths.items()
        for i in places
    ]


def test_backtest_is_that_of_forecasting_by_hand(spark):
    data = _series()
    frame = spark.createDataFrame(data, "date date, store_id int, item_id int, unit_sales double")
    history = windows.with_history(frame).withColumnRenamed("unit_sales", "y")
    known = backtest.origins(max(r[0] for r in data), folds=3, horizon=28, step=10)
    found = backtest.forecasts_from(history, known)
    want = []
    for origin in known:
        for key in {r[1:3] for r in data}:
            mine = sorted(r for r in data if r[1:3] == key)
            past = [r[3] for r in mine if r[0] <= origin]
            later = [r for r in mine if origin < r[0] <= origin + dt.timedelta(days=28)]
            if len(past) < 28:
                continue
            for step, row in enumerate(later):
                weeks = math.ceil((row[0] - origin).days / 7)
                made = (past[-1], past[-7 + step % 7], statistics.fmean(past[-7:]))
                want.append((origin, weeks, row[0], *key, row[3], *made))
    assert len(want) > 150
    assert rows(found) == sorted(want, key=repr)
    errors = {(r.origin, r.weeks_ahead, r.model): r for r in backtest.errors_by_origin(found).collect()}
    one = errors[known[0], 2, "seasonal_naive"]
    missed = [w[7] - w[5] for w in want if w[0] == known[0] and w[1] == 2]
    assert (one.n, one.mae, one.rmse, one.bias) == pytest.approx(
        (
            len(missed),
            statistics.fmean(map(abs, missed)),
            math.sqrt(statistics.fmean(m * m for m in missed)),
            statistics.fmean(missed),
        )
    )


def test_backtest_of_no_rows(spark):
    none = spark.createDataFrame([], "date date, store_id int, item_id int, unit_sales double")
    history = windows.with_history(none).withColumnRenamed("unit_sales", "y")
    made = backtest.forecasts_from(history, backtest.origins(START))
    assert backtest.errors_by_origin(made).collect() == []


# --- bootstrap ------------------------------------------------------------------------


def test_poisson_weights_are_poisson(spark):
    drawn = spark.range(40_000).select(backtest.poisson_weight(F.lit(1), F.col("id")).alias("w"))
    counts = {r.w: r["count"] / 40_000 for r in drawn.groupBy("w").count().collect()}
    for k in range(4):
        assert counts[k] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.01)


def test_interval_holds_the_improvement_and_follows_the_noise(spark):
    draw = random.Random(6)

    def table(noise):
        lines = []
        for date in _days(100):
            shared = draw.gauss(0, noise)
            for store in range(5):
                y = draw.randrange(20, 40)
                lines.append((date, float(y), y + 4.0 + shared, y + 3.0, y - 4.0 - shared))
        return spark.createDataFrame(
            lines, "date date, y double, naive double, seasonal_naive double, moving_average double"
        )

    narrow, wide = (
        {r.model: r for r in backtest.improvement_interval(table(noise)).collect()}
        for noise in (0.1, 3.0)
    )
    for found in (narrow, wide):
        assert found["seasonal_naive"].low < found["seasonal_naive"].improvement < found["seasonal_naive"].high
        same = found["moving_average"]  # misses as much, on the other side
        assert (same.low, same.improvement, same.high) == pytest.approx((0, 0, 0), abs=1e-9)
        assert same.replicates == backtest.REPLICATES
    assert narrow["seasonal_naive"].low > 0.9
    gap = [found["seasonal_naive"].high - found["seasonal_naive"].low for found in (narrow, wide)]
    assert gap[1] > 5 * gap[0]


# --- adjusted effects -----------------------------------------------------------------


def _confounded(seed=7):
    """Holidays fall on weekends and into promotions, and large series have more of them."""
    draw = random.Random(seed)
    lines = []
    for store in range(6):
        for date in _days(90):
            weekend = date.weekday() >= 5
            holiday = draw.random() < (0.5 if weekend else 0.05)
            promoted = draw.random() < (0.1 + 0.13 * store)
            y = 100 * store + 5 * weekend + 2 * holiday + 9 * promoted + draw.gauss(0, 1)
            promotion = promoted if draw.random() < 0.9 or promoted else None
            lines.append((store, 1, y, int(holiday), int(weekend), promotion, 1.0))
    return lines


EFFECTS = (
    "store_id int, item_id int, y double, is_holiday int, is_weekend int, onpromotion boolean,"
    " level double"
)


def test_adjusted_effects_are_least_squares_with_a_level_per_series(spark):
    data = _confounded()
    factors = ("is_holiday", "is_weekend", "onpromotion")
    found = {r.factor: r for r in effects.adjusted_effects(spark.createDataFrame(data, EFFECTS), factors).collect()}
    x = np.array([[r[3], r[4], bool(r[5]), *(r[0] == s for s in range(6))] for r in data], float)
    solved = np.linalg.lstsq(x, np.array([r[2] for r in data]), rcond=None)[0]
    for name, value in zip(factors, solved):
        assert found[name].effect == pytest.approx(value, abs=1e-6) and found[name].n == len(data)
    assert [found[name].effect for name in factors] == pytest.approx([2, 5, 9], abs=0.7)


def test_factors_without_variation_of_their_own(spark):
    rows_ = spark.createDataFrame(_confounded(), EFFECTS).withColumn("again", F.col("is_weekend") * 2)
    names = ("level", "is_weekend", "again", "is_holiday")
    found = {r.factor: r.effect for r in effects.adjusted_effects(rows_, names).collect()}
    assert found["level"] is None and found["again"] is None
    assert found["is_weekend"] and found["is_holiday"]
    none = effects.adjusted_effects(rows_.where("false"), names).collect()
    assert [(r.effect, r.n) for r in none] == [(None, 0)] * 4


# --- permutation importance -----------------------------------------------------------


@pytest.mark.parametrize("block", [100_000, 40])
def test_exchange_moves_every_value_once(spark, block):
    data = [(i, float(i), i * 2.0, None if i % 9 == 0 else float(i % 5)) for i in range(300)]
    table = spark.createDataFrame(data, "id int, a double, b double, c double").repartition(4)
    found = importance.exchanged(table, ("a", "b", "c"), ("id",), block).collect()
    assert sorted(r.id for r in found) == [*range(300)]
    for name in "abc":
        assert sorted((r[f"x_{name}"] for r in found), key=repr) == sorted(
            (r[name] for r in found), key=repr
        )
    assert sum(r.x_a == r.a for r in found) < 30
    # features are exchanged apart from each other
    assert sum(r.x_a * 2 == r.x_b for r in found) < 30
    again = importance.exchanged(table.repartition(2), ("a", "b", "c"), ("id",), block)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found), key=repr)


def test_importance_of_what_a_model_uses(spark):
    draw = random.Random(11)
    data = [(i, draw.random(), draw.random(), draw.random()) for i in range(2000)]
    table = spark.createDataFrame(data, "id int, a double, b double, c double")
    table = table.withColumn("y", 4 * F.col("a") + F.col("b"))
    names = ("a", "b", "c")
    plain = importance.permutation_importance(
        table, names, ("id",), lambda v: 4 * v["a"] + v["b"] + 0 * v["c"]
    )
    found = {r.feature: r.importance for r in plain.collect()}
    assert found["a"] > 3 * found["b"] > 0 == found["c"]
    assert found["a"] == pytest.approx(4 / 3, abs=0.1)  # mean distance of two draws, times 4
    each = importance.variants(importance.exchanged(table, names, ("id",)), names)
    each = each.withColumn("prediction", 4 * F.col("a") + F.col("b"))
    told = {r.feature: r.importance for r in importance.losses(each).collect()}
    assert told == pytest.approx(found)


# --- sketches -------------------------------------------------------------------------


def test_merged_sketches_are_within_their_errors(spark):
    n = 60_000
    sales = spark.range(n).select(
        F.date_add(F.lit(START), (F.col("id") % 200).cast("int")).alias("date"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("family"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("store_id"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.pow(F.col("id") % 997, F.lit(2.0))).alias("unit_sales"),
    )
    stored = sketches.monthly_sketches(sales)
    assert stored.count() == 14
    for by in ((), ("family",), ("year", "month")):
        frame = sales.withColumns({"year": F.year("date"), "month": F.month("date")})
        names = ", ".join(by) or "1"
        for row in sketches.merged_summaries(stored, *by).collect():
            mine = frame.where(" AND ".join(f"{n} = '{row[n]}'" for n in by) or "true")
            values = np.array([r[0] for r in mine.select("unit_sales").dropna().collect()])
            assert row.records == mine.count() and row.units == values.sum(), names
            assert row.stores == pytest.approx(mine.select("store_id").distinct().count(), rel=0.05)
            for q in sketches.QUANTILES:
                value = row[f"q{round(q * 100)}"]
                assert (values < value).mean() - sketches.RANK_ERROR <= q
                assert q <= (values <= value).mean() + sketches.RANK_ERROR


# --- smoothing ------------------------------------------------------------------------


def test_smoothed_demand(spark):
    draw = random.Random(4)
    data = [(d, 1, 1, draw.choice([0.0, 0.0, 3.0, 7.5])) for d in _days(60)]
    data += [(d, 1, 2, 0.0) for d in _days(5)] + [(None, 2, 1, 5.0), (START, 2, 1, 5.0)]
    data += [(START, 3, 1, None), (START, 3, 1, float("nan"))]
    schema = "date date, store_id int, item_id int, unit_sales double"
    found = smoothing.smoothed_demand(spark.createDataFrame(data, schema).repartition(3))
    size, gap, last = None, 1.0, None
    for date, *_, units in data[:60]:
        if units:
            size = units if size is None else size + 0.1 * (units - size)
            gap = gap if last is None else gap + 0.1 * ((date - last).days - gap)
            last = date
    mine = {(r.store_id, r.item_id): r for r in found.collect()}
    assert mine[1, 1][2:] == pytest.approx((size, gap, size / gap))
    assert mine[1, 2][2:] == mine[3, 1][2:] == (None, None, None)
    assert mine[2, 1][2:] == (5.0, 1.0, 5.0)


# --- fingerprints ---------------------------------------------------------------------


def test_fingerprints_do_not_depend_on_order_and_tell_tables_apart(spark):
    data = [(i % 7, None if i % 5 == 0 else f"t{i % 11}", i / 8, START) for i in range(200)]
    table = spark.createDataFrame(data, "a int, b string, c double, d date")
    moved = table.select("d", "c", "b", "a").repartition(5).orderBy(F.rand(1))
    quality.assert_same_rows(table, moved)
    others = [
        table.unionAll(table.limit(1)),
        table.withColumn("a", F.when(F.col("c") == 3, 99).otherwise(F.col("a"))),
        table.withColumn("b", F.coalesce("b", F.lit(""))),
        table.withColumnRenamed("a", "z"),
    ]
    for other in others:
        with pytest.raises(ValueError, match="do not hold the same rows"):
            quality.assert_same_rows(table, other)
    none = quality.fingerprint(table.where("false")).first()
    assert (none.row_count, none.fingerprint) == (0, "0")
    # one swapped pair of values is seen, though every column on its own is the same
    swapped = [(1, "x"), (2, "y")], [(1, "y"), (2, "x")]
    left, right = (spark.createDataFrame(pair, "a int, b string") for pair in swapped)
    with pytest.raises(ValueError):
        quality.assert_same_rows(left, right)
