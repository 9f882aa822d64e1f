"""Joins under hot keys, row numbers and running sums."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import bag
from waymark.operators import joins
from waymark.operators.joins import dimension_join, fits_broadcast, group_join, salted_join
from waymark.operators.ordering import row_index, running_sum


def facts(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(90)] + [(i, None) for i in range(90, 120)]
    return spark.createDataFrame(rows, "id int, k string")


def dimension(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3), ("k3", 4), ("none", 5), (None, 6)], "k string, v int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, nothing_fits, how):
    plain = facts(spark).join(dimension(spark), ["k"], how)
    for made in (
        salted_join(facts(spark), dimension(spark), ["k"], how),
        salted_join(facts(spark), dimension(spark), ["k"], how, spread_by=["id"]),
        dimension_join(facts(spark), dimension(spark), ["k"], how),
        group_join(facts(spark), dimension(spark), ["k"], None, how),
    ):
        assert bag(made) == bag(plain)


def test_salted_join_with_given_counts(spark, nothing_fits):
    counts = facts(spark).groupBy("k").agg(F.count("*").alias("_rows"))
    made = salted_join(facts(spark), dimension(spark), ["k"], "left", counts, ["id"])
    assert bag(made) == bag(facts(spark).join(dimension(spark), ["k"], "left"))


def test_a_hot_key_is_spread(spark, nothing_fits, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 10)
    made = salted_join(facts(spark), dimension(spark).where("v = 1"), ["k"], spread_by=["id"])
    parts = made.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 60


def test_bounds_are_measured(spark, monkeypatch):
    small = spark.range(10)
    assert fits_broadcast(small)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 9)
    assert not fits_broadcast(small)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    assert fits_broadcast(small)
    assert not fits_broadcast(small.select(F.repeat(F.lit("x"), 200).alias("t")))


def test_row_numbers_follow_the_order(spark):
    draw = random.Random(1)
    values = [draw.randint(0, 1000) for _ in range(400)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, tag int").repartition(7)
    rows = row_index(df, ["v", "tag"]).collect()
    expected = {(v, i): n for n, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))}
    assert {(r["v"], r["tag"]): r["id"] for r in rows} == expected


def test_row_numbers_of_equal_rows(spark):
    df = spark.createDataFrame([("a",)] * 300 + [("b",)] * 20, "v string").repartition(5)
    fixed = row_index(df, ["v"], to="n").collect()
    assert sorted(r["n"] for r in fixed) == list(range(320))
    assert max(r["n"] for r in fixed if r["v"] == "a") == 299


def running_rows():
    draw = random.Random(2)
    return [("hot" if i % 3 else [None, "k1", "k2"][i // 3 % 3], draw.randint(0, 80), draw.randint(-5, 9), i) for i in range(600)]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_sums(spark, by):
    rows = running_rows()
    df = spark.createDataFrame(rows, "k string, t int, v int, i int")
    expected, running = Counter(), Counter()
    for k, t, v, i in sorted(rows, key=lambda r: (r[1], r[3])):
        running[k if by else None] += v
        expected[(k, t, i, running[k]) if by else (t, i, running[None])] += 1
    assert sum(expected.values()) == len(rows)
    assert bag(running_sum(df, "t", ["v"], by, ties=["i"]), *by, "t", "i", "running_v") == expected


@pytest.mark.parametrize("by", [[], ["k"]])
def test_merged_running_sums(spark, by):
    rows = running_rows()
    totals: dict = defaultdict(Counter)
    for k, t, v, _ in rows:
        totals[k if by else None][t] += v
    expected = Counter()
    for k, points in totals.items():
        running = 0
        for t in sorted(points):
            running += points[t]
            expected[(k, t, running) if by else (t, running)] += 1
    df = spark.createDataFrame(rows, "k string, t int, v int, i int")
    assert bag(running_sum(df, "t", ["v"], by, merge=True), *by, "t", "running_v") == expected


def test_running_sums_keep_equal_rows(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 1)], "t int, v int")
    assert bag(running_sum(df, "t", ["v"]), "t", "running_v") == Counter({(1, 5): 1, (1, 10): 1, (2, 11): 1})


def test_every_hot_key_is_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 1)
    keys = 12_000
    facts = spark.range(2 * keys).select(F.col("id"), (F.col("id") % keys).alias("k"))
    other = spark.range(keys).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for rows in (1 << 20, 100):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", rows)
        made = salted_join(facts, other, ["k"], spread_by=["id"])
        assert made.count() == 2 * keys and made.where("v <> 2 * k").count() == 0


def test_streams_are_joined_whatever_the_size(spark, nothing_fits, tmp_path):
    spark.range(20).withColumn("k", F.col("id") % 3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, k long").parquet(str(tmp_path / "in"))
    dimension = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    query = dimension_join(stream, dimension, ["k"]).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 14


def test_running_sums_over_missing_values(spark):
    from pyspark.sql import Window

    draw = random.Random(3)
    rows = [(t, None if t < 5 or draw.random() < 0.6 else draw.randint(1, 9)) for t in range(200)]
    df = spark.createDataFrame(rows, "t int, v int").repartition(6)
    plain = df.withColumn("running_v", F.sum("v").over(Window.orderBy("t"))).select("t", "running_v")
    assert bag(running_sum(df, "t", ["v"])) == bag(plain)


def test_rows_with_maps(spark, nothing_fits):
    df = facts(spark).withColumn("m", F.create_map(F.col("id"), F.col("k")))
    assert row_index(df, ["id"], to="n").where("n = id").count() == 120
    made = salted_join(df, dimension(spark), ["k"], "left")
    assert made.count() == df.join(dimension(spark), ["k"], "left").count()
