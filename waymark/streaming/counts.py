"""Requests counted while the log arrives: the deduplication of `operators.dedup` on a stream.

Rows are counted per request and span of time in keyed state. The watermark closes a span: its state goes, and rows that come for
it later are left out. Each micro-batch writes the counts that it changed to a folder of its own and replaces what a broken run left
there; the last count of a request and span holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.dedup import COUNT, present_keys
from waymark.operators.filters import TIMESTAMP
from waymark.streaming.sinks import read_saved

SPAN = "_span"


def count_requests(
    stream: DataFrame, path: str, checkpoint: str, late: str = "1 day", span: str = "1 day", extra_keys: Sequence[str] = (),
    column: str = TIMESTAMP,
) -> int:
    """Counts what is available now and waits for the end; gives the number of rows that came too late.

    A row comes in time while its span (`span` long, from midnight) ends after the newest time seen in earlier runs, less `late`; rows
    without a time are left out. The same checkpoint goes on where the run before ended, with its state.
    """
    keys = present_keys(stream, extra_keys)
    # Watermarks need an instant; a time without zone counts as one of the session's.
    timed = stream.withColumn("_seen", F.col(column).cast("timestamp"))
    # Grouped by the window itself: a field of it would not be known to follow the watermark.
    counted = timed.withWatermark("_seen", late).groupBy(F.window("_seen", span).alias(SPAN), *keys).agg(F.count(F.lit(1)).alias(COUNT))
    counted = counted.withColumn(SPAN, F.col(SPAN)["end"])

    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = counted.writeStream.foreachBatch(save).outputMode("update").option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(int(state["numRowsDroppedByWatermark"]) for progress in query.recentProgress for state in progress["stateOperators"])


def request_counts(spark: SparkSession, path: str, schema: T.StructType, extra_keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct request with its count, from the counts saved under `path`; `schema` is the log's.

    A request has a row per span and micro-batch that met it, merged before the shuffle.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    keys = present_keys(spark.createDataFrame([], schema), extra_keys)
    saved = T.StructType([
        T.StructField(SPAN, T.TimestampType()), *[T.StructField(k, kinds[k]) for k in keys],
        T.StructField(COUNT, T.LongType()), T.StructField("batch", T.LongType()),
    ])
    updates = read_saved(spark, path, saved)
    # Counts only grow while a span is open, so the greatest is the last.
    spans = updates.groupBy(*keys, SPAN).agg(F.max(COUNT).alias(COUNT))
    return spans.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT))
