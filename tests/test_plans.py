"""Physical plans: what reaches the scan, what is broadcast, what is shuffled once."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from helpers import plan
from waymark.operators import filters as f
from waymark.plans.preprocess import preprocess


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_no_python_no_cross_join_no_single_task(spark, sf, name):
    text = plan(entry_points.queries()[name](spark, sf))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # Windows without a key only run over one row per partition.
    for node in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: SinglePartition", text):
        assert "searched_query" not in node and "lib_postal_result" not in node


def test_look_back_reaches_the_scan(spark, sf):
    logs = spark.read.parquet(f"{sf}/events.parquet").withColumnRenamed("ts", f.TIMESTAMP)
    text = plan(logs.where(f.looked_back("2024-01-31", 20)).select("event_id"))
    assert "GreaterThan(ts,2024-01-11" in text
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", text)


def test_preprocessing_does_not_shuffle(spark, sf):
    from waymark.fixtures import view

    logs = view(spark, sf, "search_logs")
    assert plan(preprocess(logs)).count("Exchange") == plan(logs).count("Exchange")


def test_the_sampler_shuffles_the_log_once(spark, sf):
    df = entry_points.queries()["sampler"](spark, sf)
    df.collect()
    final = plan(df).split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_filtered_countries_are_a_semi_join(spark, sf):
    assert "LeftSemi" in plan(entry_points.queries()["filter_country"](spark, sf))
