"""Bootstrap, running sums, snapshots and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.pieces import bootstrap_steps, poisson_sql, time_sql, time_text
from waymark.catalog.registry import query
from waymark.fixtures import read_table, view
from waymark.functions.text import parse_dmy, run_label
from waymark.operators.ordering import running_sum
from waymark.operators.quantiles import CELLS as QUANTILE_CELLS, SLOTS, quantile_ci, quantile_replicates
from waymark.operators.snapshots import growth_snapshots, indicator_year, on_dates
from waymark.operators.stats import bootstrap_ci, bootstrap_replicates

TIMES = 1000
STEPS = bootstrap_steps("events", "event_id", "value", TIMES)
LOW = (1 - 0.9) / 2


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


@query("bootstrap_replicates", [], "SELECT CAST(replicate AS INTEGER) AS replicate, round(estimate, 6) AS estimate FROM replicates", STEPS)
def _replicates(spark: SparkSession, sf: str) -> DataFrame:
    return bootstrap_replicates(_events(spark, sf), "event_id", "value", times=TIMES).withColumn("estimate", F.round("estimate", 6))


@query("bootstrap_ci", [], f"""
SELECT round(quantile_cont(estimate, {LOW}), 6) AS lower_bound, round(quantile_cont(estimate, {LOW + 0.9}), 6) AS upper_bound
FROM replicates""", STEPS)
def _interval(spark: SparkSession, sf: str) -> DataFrame:
    bounds = bootstrap_ci(_events(spark, sf), "event_id", "value", times=TIMES)
    return bounds.select(*[F.round(c, 6).alias(c) for c in bounds.columns])


# In cents: sums of whole numbers are the same in any order.
@query("bootstrap_sum", [], "SELECT CAST(replicate AS INTEGER) AS replicate, round(estimate, 4) AS estimate FROM replicates",
       bootstrap_steps("(SELECT event_id, round(value * 100) AS cents FROM events)", "event_id", "cents", TIMES, "sum"))
def _sums(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf).select("event_id", F.round(F.col("value") * 100).alias("cents"))
    return bootstrap_replicates(events, "event_id", "cents", "sum", TIMES).withColumn("estimate", F.round("estimate", 4))


# Clicks per value, and the number of events with a value above 50.
CLICKS = "(SELECT *, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicked, CASE WHEN value > 50 THEN value END AS high FROM events)"


@query("bootstrap_ratio", [], "SELECT CAST(replicate AS INTEGER) AS replicate, round(estimate, 6) AS estimate FROM replicates",
       bootstrap_steps(CLICKS, "event_id", "clicked", TIMES, "ratio", "sum(value)"))
def _ratio(spark: SparkSession, sf: str) -> DataFrame:
    clicks = _events(spark, sf).withColumn("clicked", (F.col("event_type") == "click").cast("int"))
    drawn = bootstrap_replicates(clicks, "event_id", "clicked", "ratio", TIMES, denominator="value")
    return drawn.withColumn("estimate", F.round("estimate", 6))


@query("bootstrap_count", [], "SELECT CAST(replicate AS INTEGER) AS replicate, round(estimate, 4) AS estimate FROM replicates",
       bootstrap_steps(CLICKS, "event_id", "high", TIMES, "count"))
def _counts(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf).withColumn("high", F.when(F.col("value") > 50, F.col("value")))
    return bootstrap_replicates(events, "event_id", "high", "count", TIMES).withColumn("estimate", F.round("estimate", 4))


def quantile_steps(q: float) -> dict[str, str]:
    """Replicates of a quantile of the events' values over all slots between the least and the greatest."""
    draw = "substr(md5(concat(CAST(cell AS VARCHAR), '-', CAST(t // 4 AS VARCHAR), '-0')), CAST(1 + 8 * (t % 4) AS INTEGER), 8)"
    return {
        "bounds": "SELECT min(value) AS low, max(value) AS high FROM events",
        "placed": f"""SELECT CAST(concat('0x', substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % {QUANTILE_CELLS} AS cell,
least(CAST(floor((value - low) / (high - low) * {SLOTS}) AS INTEGER), {SLOTS - 1}) AS slot FROM events, bounds""",
        "weights": f"SELECT cell, t, {poisson_sql(draw)} AS w FROM (SELECT DISTINCT cell FROM placed), (SELECT unnest(range({TIMES})) AS t)",
        "slots": "SELECT t, slot, CAST(sum(w * n) AS DOUBLE) AS w FROM (SELECT cell, slot, count(*) AS n FROM placed GROUP BY ALL) JOIN weights USING (cell) GROUP BY t, slot HAVING sum(w * n) > 0",
        "summed": "SELECT *, sum(w) OVER (PARTITION BY t ORDER BY slot) AS past, sum(w) OVER (PARTITION BY t) AS total FROM slots",
        "replicates": f"""SELECT t AS replicate, low + (slot + ({q} * total - (past - w)) / w) * ((high - low) / {SLOTS}) AS estimate
FROM (SELECT * FROM summed WHERE past >= {q} * total QUALIFY row_number() OVER (PARTITION BY t ORDER BY slot) = 1), bounds""",
    }


@query("bootstrap_median", [], "SELECT CAST(replicate AS INTEGER) AS replicate, round(estimate, 6) AS estimate FROM replicates", quantile_steps(0.5))
def _median(spark: SparkSession, sf: str) -> DataFrame:
    return quantile_replicates(_events(spark, sf), "event_id", "value", times=TIMES).withColumn("estimate", F.round("estimate", 6))


@query("bootstrap_quantile_ci", [], f"""
SELECT round(quantile_cont(estimate, {LOW}), 6) AS lower_bound, round(quantile_cont(estimate, {LOW + 0.9}), 6) AS upper_bound
FROM replicates""", quantile_steps(0.9))
def _quantile_interval(spark: SparkSession, sf: str) -> DataFrame:
    bounds = quantile_ci(_events(spark, sf), "event_id", "value", 0.9, times=TIMES)
    return bounds.select(*[F.round(c, 6).alias(c) for c in bounds.columns])


# The hour makes many events equal in the index.
HOURLY = "(SELECT *, date_trunc('hour', ts) AS hour FROM events)"


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


@query("running_sum", [], f"""
SELECT event_id, user_id, {time_sql('hour', 'seen')}, round(sum(value) OVER (
  PARTITION BY user_id ORDER BY hour, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_value FROM {HOURLY}""")
def _running(spark: SparkSession, sf: str) -> DataFrame:
    summed = running_sum(_hourly(spark, sf), "hour", ["value"], ["user_id"], ties=["event_id"])
    return summed.select("event_id", "user_id", time_text("hour", "seen"), F.round("running_value", 4).alias("running_value"))


@query("running_sum_global", [], f"""
SELECT event_id, {time_sql('hour', 'seen')}, round(sum(value) OVER (
  ORDER BY hour, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_value FROM {HOURLY}""")
def _running_global(spark: SparkSession, sf: str) -> DataFrame:
    summed = running_sum(_hourly(spark, sf), "hour", ["value"], ties=["event_id"])
    return summed.select("event_id", time_text("hour", "seen"), F.round("running_value", 4).alias("running_value"))


@query("running_sum_merged", [], f"""
SELECT {time_sql('hour', 'seen')}, round(sum(v) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_value
FROM (SELECT hour, sum(value) AS v FROM {HOURLY} GROUP BY hour)""")
def _running_merged(spark: SparkSession, sf: str) -> DataFrame:
    summed = running_sum(_hourly(spark, sf), "hour", ["value"], merge=True)
    return summed.select(time_text("hour", "seen"), F.round("running_value", 4).alias("running_value"))


SNAPSHOTS = """
SELECT country, iso_alpha, year, round(lifeExp * pow(1.1, k), 6) AS lifeExp,
  strftime(DATE '2022-01-01' + to_months(CAST(k - 1 AS INTEGER)), '%Y-%m-%d') AS date
FROM country_indicator, (SELECT unnest(range(1, 18)) AS k)"""


def _plain(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumns({"lifeExp": F.round("lifeExp", 6), "date": F.col("date").cast("string")})


@query("growth_snapshots", ["country_indicator"], SNAPSHOTS)
def _growth(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(growth_snapshots(view(spark, sf, "country_indicator")))


@query("indicator_filter", ["country_indicator"], "SELECT * FROM snapshots WHERE year = 2007 AND lifeExp IS NOT NULL AND date = '2022-03-01'", {"snapshots": SNAPSHOTS})
def _indicator(spark: SparkSession, sf: str) -> DataFrame:
    snapshots = growth_snapshots(indicator_year(view(spark, sf, "country_indicator")))
    return _plain(on_dates(snapshots, [dt.date(2022, 3, 1)]))


@query("parse_dmy", [], """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%d-%m-%Y') AS label FROM events""")
def _dmy(spark: SparkSession, sf: str) -> DataFrame:
    texts = _events(spark, sf).select("event_id", F.date_format("ts", "d/M/yyyy").alias("text"))
    days = texts.select("event_id", parse_dmy(F.col("text")).alias("_day"))
    return days.select("event_id", F.col("_day").cast("string").alias("day"), run_label(F.col("_day")).alias("label"))
