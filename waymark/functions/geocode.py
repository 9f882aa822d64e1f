"""First result of a geocoder response as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.schemas import RESPONSE_SCHEMA


def check_threshold(threshold: float | None) -> None:
    if threshold is not None and not 0 <= threshold <= 1:
        raise ValueError(f"threshold must be between 0 and 1, not {threshold}")


def limit_results(results: Column, limit: int) -> Column:
    """The first `limit` results."""
    return F.slice(results, 1, limit)


def read_response(response: Column, strict: bool = False) -> Column:
    """Response text as a struct; `strict` fails on a response that has no result list at all."""
    reply = F.from_json(response, RESPONSE_SCHEMA)
    if not strict:
        return reply
    broken = response.isNotNull() & reply["results"].isNull()
    return F.when(broken, F.raise_error(F.concat(F.lit("response without results: "), response))).otherwise(reply)


def result_columns(reply: Column, threshold: float | None = 0.85) -> dict[str, Column]:
    """Columns of the first result.

    A response without results gives confidence and match -1 and no other value; no response gives NULLs.
    match needs a confidence above the threshold, so an equal one stays 0.
    """
    check_threshold(threshold)
    first = F.get(reply["results"], F.lit(0))
    empty = F.size(reply["results"]) == 0
    score = first["matchConfidence"]["score"]
    passes = F.lit(None).cast("int") if threshold is None else (score > threshold).cast("int")
    return {
        "original_formatted_query": F.when(~empty, reply["summary"]["query"]),
        "confidence": F.when(empty, F.lit(-1.0)).otherwise(score),
        "lat": first["position"]["lat"],
        "lon": first["position"]["lon"],
        "query_type": first["type"],
        "bounding_box": F.when(~empty, F.coalesce(first["boundingBox"], F.lit("None"))),
        "match": F.when(empty, F.lit(-1)).otherwise(passes),
    }
