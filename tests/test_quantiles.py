"""Bootstrap of medians and other quantiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from waymark.operators import quantiles
from waymark.operators.quantiles import draws, neighbourhood, quantile_ci, quantile_replicates, slot_of
from waymark.operators.stats import poisson_weight


def table(spark, values):
    return spark.createDataFrame(pd.DataFrame({"id": range(len(values)), "v": values}))


@pytest.mark.parametrize("n", [4_000, 200_000])
@pytest.mark.parametrize("q", [0.5, 0.9])
def test_intervals_like_draws_of_n_of_n(spark, n, q):
    generator = np.random.default_rng(3)
    values = generator.lognormal(3, 1, n)
    low, high = quantile_ci(table(spark, values), "id", "v", q, times=1000).first()
    drawn = [np.quantile(generator.choice(values, n), q) for _ in range(1000)]
    want_low, want_high = np.quantile(drawn, [0.05, 0.95])
    assert high - low == pytest.approx(want_high - want_low, rel=0.12)
    assert (low + high) / 2 == pytest.approx((want_low + want_high) / 2, abs=0.12 * (want_high - want_low))


def test_draws_are_those_of_the_other_replicates(spark):
    made = draws(10, 6, 4)
    text = F.substring(F.md5(F.concat_ws("-", F.col("cell").cast("string"), F.floor(F.col("t") / 4).cast("string"), F.lit("4"))), (1 + 8 * (F.col("t") % 4)).cast("int"), F.lit(8))
    cells = spark.range(6).withColumnRenamed("id", "cell").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(9))))
    rows = cells.select("cell", "t", poisson_weight(text).alias("w")).collect()
    assert {(r["cell"], r["t"]): r["w"] for r in rows} == {(c, t): made[t, c] for c in range(6) for t in range(10)}


def test_few_cells_by_hand(spark):
    """Each replicate against the weighted quantile of its own draws, to a slot's width."""
    values = np.random.default_rng(1).uniform(0, 100, 400)
    df = table(spark, values)
    cells = {r["id"]: r["c"] for r in df.select("id", quantiles.cell_of("id", 16).alias("c")).collect()}
    weights = draws(20, 16, 7)
    got = {r["replicate"]: r["estimate"] for r in quantile_replicates(df, "id", "v", 0.3, 20, 7, cells=16).collect()}
    order = np.argsort(values)
    for t in range(20):
        own = np.cumsum([weights[t, cells[i]] for i in order])
        want = values[order][np.searchsorted(own, 0.3 * own[-1])]
        assert got[t] == pytest.approx(want, abs=2 * 100 / quantiles.SLOTS)


def test_values_that_count_for_nothing(spark):
    rows = [(i, float(i)) for i in range(50)] + [(50, None), (51, float("nan")), (52, float("inf")), (53, float("-inf"))]
    with_odd = quantile_replicates(spark.createDataFrame(rows, "id long, v double"), "id", "v", times=8).collect()
    assert with_odd == quantile_replicates(spark.createDataFrame(rows[:50], "id long, v double"), "id", "v", times=8).collect()
    none = quantile_replicates(spark.createDataFrame(rows[50:], "id long, v double"), "id", "v", times=5).collect()
    assert [(r["replicate"], r["estimate"]) for r in none] == [(t, None) for t in range(5)]
    empty = spark.createDataFrame([], "id long, v double")
    assert quantile_ci(empty, "id", "v").first() == (None, None)


def test_one_value_and_many_ties(spark):
    same = quantile_ci(table(spark, np.full(100, 7.0)), "id", "v").first()
    assert tuple(same) == (7.0, 7.0)
    # Nine tenths of the rows hold one value, which is median and p80 of nearly any draw.
    values = np.concatenate([np.full(9_000, 5.0), np.linspace(0, 1e9, 1_000)])
    low, high = quantile_ci(table(spark, values), "id", "v", 0.5).first()
    assert low == pytest.approx(5, abs=1e-3) and high == pytest.approx(5, abs=1e-3)


def test_the_neighbourhood_narrows_around_far_values(spark):
    """Among values up to 10^12 the slots must close in on a median near 1."""
    values = np.concatenate([np.random.default_rng(2).normal(1, 0.1, 20_000), [1e12, -1e12]])
    low, high, first, last = neighbourhood(table(spark, values).select(F.col("v").alias("_value")), 0.5)
    assert high - low < 100 and last - first + 1 >= quantiles.LEAST_SLOTS
    low, high = quantile_ci(table(spark, values), "id", "v").first()
    assert 0.99 < low < high < 1.01


def test_slots(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (-1.0,), (11.0,)], "v double")
    got = [r[0] for r in rows.select(slot_of(F.col("v"), 0.0, 10.0)).collect()]
    assert got == [0, quantiles.SLOTS // 10, quantiles.SLOTS - 1, -1, quantiles.SLOTS]


@pytest.mark.parametrize("wrong", [{"q": 0}, {"q": 1}, {"times": 0}])
def test_wrong_arguments(spark, wrong):
    with pytest.raises(ValueError):
        quantile_replicates(table(spark, np.zeros(1)), "id", "v", **wrong)
