"""Queries joined with geocoder responses, and the confident results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.geocode import check_threshold, limit_results, read_response, result_columns
from waymark.functions.text import geocode_url, poi_url, reverse_url
from waymark.operators.filters import confident, not_nearby
from waymark.operators.joins import salted_join
from waymark.operators.ordering import row_index
from waymark.operators.ranking import random_sample
from waymark.sources.sinks import write_results
from waymark.sources.tables import read_by_format

RESULT_COLUMNS = [
    "original_formatted_query", "confidence", "lat", "lon", "query_type", "id", "bounding_box", "searched_query", "match",
]
SAMPLE_SEED = 101


# What a request of each kind is made of.
REQUESTS = {
    "geocode": ["searched_query", "country"],
    "reverseGeocode": ["lat", "lon", "country"],
    "fullReverseGeocode": ["lat", "lon", "country"],
    "poiSearch": ["name", "lat", "lon", "search_radius_m"],
}


def request_table(
    df: DataFrame, host: str, kr_host: str | None = None, limit: int = 5, call_type: str = "geocode",
) -> DataFrame:
    """One row per distinct request with its address, for a client outside Spark. Countries may be missing."""
    if call_type not in REQUESTS:
        raise ValueError(f"call_type must be one of {list(REQUESTS)}, not {call_type!r}")
    parts = REQUESTS[call_type]
    asked = df.select(*parts).na.drop(subset=[p for p in parts if p != "country"]).distinct()
    columns = [F.col(p) for p in parts]
    if call_type == "geocode":
        url = geocode_url(*columns, host, kr_host or host, limit)
    elif call_type == "poiSearch":
        url = poi_url(*columns, host, limit)
    else:
        url = reverse_url(*columns, host, kr_host or host, limit)
    return asked.withColumn("request_url", url)


def geocode_enrich(
    rows: DataFrame, responses: DataFrame, threshold: float | None = 0.85, limit: int | None = None,
    strict: bool = False, id_column: str = "id",
) -> DataFrame:
    """Rows with the parsed first result of their query; `responses` holds (searched_query, response) once per
    query.

    Each distinct query meets its response and is parsed once. The result then goes back to the rows, with
    frequent queries spread over tasks. Rows without a response keep NULLs.
    """
    check_threshold(threshold)
    queries = rows.groupBy("searched_query").agg(F.count(F.lit(1)).alias("_rows"))
    replies = queries.join(responses, "searched_query").select(
        "searched_query", read_response(F.col("response"), strict).alias("_reply")
    )
    if limit is not None:
        replies = replies.withColumn("_reply", F.col("_reply").withField("results", limit_results(F.col("_reply.results"), limit)))
    columns = F.struct(*[column.alias(name) for name, column in result_columns(F.col("_reply"), threshold).items()])
    # Through inline() a later filter on a result stays behind the parsing instead of parsing again before it.
    parsed = replies.select("searched_query", F.inline(F.array(columns)))
    return salted_join(rows, parsed, ["searched_query"], "left", queries, [id_column])


def geocode_results(
    logs: DataFrame, responses: DataFrame, order: Sequence[str], threshold: float | None = 0.85, limit: int = 5,
    test_size: int | None = None, save_path: str | None = None, strict: bool = False,
) -> DataFrame:
    """The result table of a log: rows numbered in the stated order, geocoded, kept from the threshold on.

    `test_size` takes a seeded sample of that many rows; None or 0 takes all. With a `save_path` the results
    are written there once and come back from there.
    """
    needed = dict.fromkeys(["searched_query", "method_name", *order])
    numbered = row_index(logs.select(*needed), order)
    if test_size:
        numbered = random_sample(numbered, test_size, SAMPLE_SEED, id_columns=["id"])
    asked = numbered.where(not_nearby()).select("id", "searched_query")
    results = geocode_enrich(asked, responses, threshold, limit, strict).where(confident(threshold)).select(*RESULT_COLUMNS)
    if not save_path:
        return results
    write_results(results, save_path)
    return read_by_format(logs.sparkSession, save_path, schema=results.schema, sep=",", file_format="csv")


def geocode_file(spark: SparkSession, path: str, responses: DataFrame, order: Sequence[str], **options) -> DataFrame:
    """`geocode_results` on a saved table."""
    return geocode_results(read_by_format(spark, path), responses, order, **options)
