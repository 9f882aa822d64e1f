"""Equal log rows merged into one with their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.schemas import LOG_KEYS

COUNT = "search_query_counts"


def present_keys(df: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    """The log keys that `df` has, after the `extra` ones."""
    return [*extra, *[k for k in LOG_KEYS if k in df.columns]]


def dedup_count(df: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct request with its count. Counts are merged before the shuffle, so a request
    that makes up most of the log sends one row per task."""
    return df.groupBy(*present_keys(df, extra_keys)).agg(F.count(F.lit(1)).alias(COUNT))
