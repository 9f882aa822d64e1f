"""Address components and rebuilt queries of a log sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from waymark.functions.address import parse_components, parse_structured, rebuild_queries
from waymark.schemas import ALL_ESCAPES, COMMA_PARTS
from waymark.sources.sinks import write_parsed
from waymark.sources.tables import read_by_format


def preprocess(
    logs: DataFrame, rebuild: str = "commas", escapes: Mapping[str, str] = ALL_ESCAPES,
    parts: Sequence[str] = COMMA_PARTS,
) -> DataFrame:
    """Component columns for all rows, and the query of structured requests made from them. Map-only; the same
    on a batch and on a stream."""
    return rebuild_queries(parse_structured(parse_components(logs)), rebuild, escapes, parts)


def preprocess_file(spark: SparkSession, path: str, save_path: str | None = None, sep: str = ";", **options) -> DataFrame:
    """`preprocess` on a CSV or parquet path, saved as parquet where a path is given."""
    parsed = preprocess(read_by_format(spark, path, sep=sep), **options)
    if not save_path:
        return parsed
    write_parsed(parsed, save_path)
    return spark.read.parquet(save_path)
