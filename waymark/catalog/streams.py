"""Append streams of log rows. The given tables are read as a stream; the dimensions stay batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.address import PARSED
from waymark.catalog.pieces import FIXTURE_KEYS, KEYS, PREPROCESS_STEPS
from waymark.catalog.registry import query
from waymark.fixtures import BASE_TABLES, read_table, view
from waymark.operators.filters import TIMESTAMP
from waymark.plans.preprocess import preprocess
from waymark.session import new_path
from waymark.streaming.counts import count_requests, request_counts
from waymark.streaming.sinks import append_stream, read_saved, read_stream


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The search logs derived from a stream of events."""
    # A pattern, since a stream does not take the path of a single file.
    return view(spark, sf, "search_logs", events=read_stream(spark, f"{sf}/events.parquet*", BASE_TABLES["events"]))


SAVED = "log_id, request_uri, searched_query, countryName, method_name"


@query("stream_append_sink", ["search_logs"], f"SELECT {SAVED} FROM search_logs")
def _append(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "stream")
    append_stream(_log_stream(spark, sf).select(*SAVED.split(", ")), path, f"{path}-checkpoint")
    return read_saved(spark, path)


@query("stream_parse", ["search_logs"], f"SELECT {', '.join(PARSED)} FROM rebuilt", PREPROCESS_STEPS)
def _parse(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "stream-parsed")
    append_stream(preprocess(_log_stream(spark, sf)).select(*PARSED), path, f"{path}-checkpoint")
    return read_saved(spark, path)


# The log comes in four deliveries of eight days; of each nine events one is a delivery late and one two deliveries.
DELIVERIES = 4
DELIVERY = """CAST(least(3, floor((day(ts) - 1) / 8) + CASE WHEN event_id % 9 = 4 THEN 1 WHEN event_id % 9 = 5 THEN 2 ELSE 0 END) AS INT)"""
LATE_HOURS = 30


@query("stream_dedup_count", ["search_logs"], f"""
SELECT {KEYS}, count(*) AS search_query_counts FROM search_logs JOIN delivered ON log_id = event_id
JOIN (SELECT delivery, max(newest) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM (SELECT delivery, max(client_received_start_timestamp) AS newest FROM delivered JOIN search_logs ON log_id = event_id GROUP BY delivery)) USING (delivery)
WHERE seen IS NULL OR date_trunc('day', client_received_start_timestamp) + INTERVAL 1 DAY > seen - INTERVAL {LATE_HOURS} HOUR
GROUP BY {KEYS}""", {"delivered": f"SELECT event_id, {DELIVERY} AS delivery FROM events"})
def _count(spark: SparkSession, sf: str) -> DataFrame:
    root = new_path(spark, "stream-counts")
    events = read_table(spark, sf, "events").withColumn("_delivery", F.expr(DELIVERY))
    schema = view(spark, sf, "search_logs").select(*FIXTURE_KEYS, TIMESTAMP).schema
    for number in range(DELIVERIES):
        events.where(F.col("_delivery") == number).drop("_delivery").write.mode("append").parquet(f"{root}/events")
        stream = read_stream(spark, f"{root}/events", BASE_TABLES["events"])
        logs = view(spark, sf, "search_logs", events=stream).select(*FIXTURE_KEYS, TIMESTAMP)
        count_requests(logs, f"{root}/counts", f"{root}/checkpoint", late=f"{LATE_HOURS} hours")
    return request_counts(spark, f"{root}/counts", schema)
