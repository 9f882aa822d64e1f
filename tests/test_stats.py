"""Bootstrap, coverage, snapshots, reports."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import bag
from waymark.functions.text import parse_dmy, run_label
from waymark.operators.reports import api_status_report, null_result_count
from waymark.operators.snapshots import growth_snapshots, indicator_year, on_dates
from waymark.operators.stats import (
    bootstrap_ci, bootstrap_replicates, component_coverage, percentile_interval, poisson_limits, poisson_weight,
)
from waymark.schemas import FLAG_COLUMNS


@pytest.fixture(scope="module")
def numbers(spark):
    values = np.random.default_rng(5).normal(10, 2, 4000)
    return spark.createDataFrame(pd.DataFrame({"id": range(4000), "v": values, "hit": (values > 10).astype(int)})), values


def test_poisson_weights_have_the_right_distribution(spark):
    draws = spark.range(200_000).select(poisson_weight(F.substring(F.md5(F.col("id").cast("string")), 1, 8)).alias("w"))
    mean, variance, zero = draws.agg(F.mean("w"), F.var_pop("w"), F.mean((F.col("w") == 0).cast("int"))).first()
    assert mean == pytest.approx(1, abs=0.01) and variance == pytest.approx(1, abs=0.02)
    assert zero == pytest.approx(np.exp(-1), abs=0.005)
    assert poisson_limits() == sorted(poisson_limits()) and all(len(x) == 8 for x in poisson_limits())


@pytest.mark.parametrize("cells", [1 << 20, 1 << 11])
def test_replicates_spread_like_the_mean(numbers, cells):
    df, values = numbers
    got = bootstrap_replicates(df, "id", "v", times=1000, cells=cells).toPandas()
    assert sorted(got["replicate"]) == list(range(1000))
    assert got["estimate"].mean() == pytest.approx(values.mean(), abs=0.01)
    assert got["estimate"].std() == pytest.approx(values.std() / np.sqrt(4000), rel=0.12)


def test_interval_holds_the_estimate_and_narrows_with_confidence(numbers):
    df, values = numbers
    low, high = bootstrap_ci(df, "id", "v", times=400).first()
    inner_low, inner_high = bootstrap_ci(df, "id", "v", conf=0.5, times=400).first()
    assert low < inner_low < values.mean() < inner_high < high


def test_statistics_and_seeds(numbers):
    df, values = numbers
    hits = int((values > 10).sum())
    means = {
        "sum": values.sum(), "count": 4000, "mean": values.mean(),
    }
    for statistic, expected in means.items():
        got = bootstrap_replicates(df, "id", "v", statistic, times=40).agg(F.mean("estimate")).first()[0]
        assert got == pytest.approx(expected, rel=0.02)
    ratio = bootstrap_replicates(df, "id", "hit", "ratio", times=41, denominator="v")
    assert ratio.count() == 41
    assert ratio.agg(F.mean("estimate")).first()[0] == pytest.approx(hits / values.sum(), rel=0.02)
    first = bag(bootstrap_replicates(df, "id", "v", times=8), "replicate", "estimate")
    assert first == bag(bootstrap_replicates(df.repartition(3), "id", "v", times=8), "replicate", "estimate")
    assert first != bag(bootstrap_replicates(df, "id", "v", times=8, seed=1), "replicate", "estimate")
    for wrong in (dict(statistic="median"), dict(statistic="ratio"), dict(times=0)):
        with pytest.raises(ValueError):
            bootstrap_replicates(df, "id", "v", **wrong)


@pytest.mark.parametrize(("rows", "cells"), [(4000, 1 << 14), (200_000, 1 << 14)])
def test_replicates_spread_like_draws_of_n_of_n(spark, rows, cells):
    draw = np.random.default_rng(11)
    values, below = draw.normal(10, 2, rows), draw.uniform(1, 3, rows)
    present = draw.random(rows) < 0.7
    df = spark.createDataFrame(pd.DataFrame({"id": range(rows), "v": values, "b": below, "p": present})).withColumn("w", F.when(F.col("p"), F.col("v")))
    drawn = [draw.integers(0, rows, rows) for _ in range(400)]
    expected = {
        ("v", "sum"): [values[d].sum() for d in drawn], ("v", "mean"): [values[d].mean() for d in drawn],
        ("v", "ratio"): [values[d].sum() / below[d].sum() for d in drawn], ("w", "count"): [present[d].sum() for d in drawn],
        ("w", "sum"): [(values * present)[d].sum() for d in drawn],
    }
    for (column, statistic), want in expected.items():
        got = bootstrap_replicates(df, "id", column, statistic, times=1000, cells=cells, denominator="b" if statistic == "ratio" else None)
        mean, spread = got.agg(F.mean("estimate"), F.stddev("estimate")).first()
        # 400 draws know the spread to about 3.5 %.
        assert mean == pytest.approx(np.mean(want), rel=0.01) and spread == pytest.approx(np.std(want), rel=0.12)
    assert {round(r["estimate"], 6) for r in bootstrap_replicates(df, "id", "v", "count", times=50).collect()} == {rows}


def test_interval_interpolates_like_numpy(spark):
    values = np.random.default_rng(2).normal(size=37)
    df = spark.createDataFrame(pd.DataFrame({"estimate": values}))
    assert tuple(percentile_interval(df, 0.8).first()) == pytest.approx(tuple(np.quantile(values, [0.1, 0.9])))
    with pytest.raises(ValueError):
        percentile_interval(df, 1.0)


def test_coverage(spark):
    flags = list(FLAG_COLUMNS.values())
    df = spark.createDataFrame([("ES", *[i == j for j in range(19)]) for i in range(3)], "country string, " + ", ".join(f"{f} boolean" for f in flags))
    row = component_coverage(df).first().asDict()
    assert row["rows"] == 3 and [row[f] for f in flags] == [1, 1, 1] + [0] * 16


def test_snapshots(spark):
    df = spark.createDataFrame([("a", 2007, 10.0), ("b", 2002, 10.0), ("c", 2007, None)], "country string, year int, lifeExp double")
    rows = growth_snapshots(indicator_year(df)).orderBy("date").collect()
    assert [r["date"] for r in rows] == [dt.date(2022 + m // 12, m % 12 + 1, 1) for m in range(17)]
    value = 10.0
    for row in rows:
        value *= 1.1
        assert row["lifeExp"] == pytest.approx(value)
    assert on_dates(growth_snapshots(df), [dt.date(2023, 5, 1)]).count() == 3


def test_dates(spark):
    row = spark.createDataFrame([("1/12/2022",)], "t string").select(parse_dmy(F.col("t")).alias("d")).select("d", run_label(F.col("d"))).first()
    assert tuple(row) == (dt.date(2022, 12, 1), "01-12-2022")


def test_reports(spark):
    df = spark.createDataFrame([([{"a": "b"}], 1), (None, 2), (None, 2)], "apiResults array<map<string,string>>, apiCalls int")
    assert bag(api_status_report(df), "api_status", "apiCalls", "count") == Counter({(1, 1, 1): 1, (0, 2, 2): 1})
    assert tuple(null_result_count(df).first()) == (3, 2)
