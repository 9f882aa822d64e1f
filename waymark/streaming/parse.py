"""The preprocessing steps on a stream of new log rows."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from waymark.plans.preprocess import preprocess
from waymark.streaming.sinks import append_stream, read_stream


def parse_stream(
    spark: SparkSession, path: str, schema: T.StructType, save_path: str, checkpoint: str, rebuild: str = "commas",
    files_per_batch: int | None = None,
) -> None:
    """Parses the log files that are new under `path` and appends them to `save_path`."""
    logs = read_stream(spark, path, schema, files_per_batch=files_per_batch)
    append_stream(preprocess(logs, rebuild), save_path, checkpoint)
