"""SQL pieces that several oracles share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.fixtures import NOW
from waymark.schemas import ALL_ESCAPES, COMMA_PARTS, COMPONENT_COLUMNS, LOG_KEYS, SPACED_PARTS, STRUCTURED_COLUMNS

FIXTURE_KEYS = [
    k for k in LOG_KEYS if k in {
        "request_uri", "searched_query", "populated_fields", "ordered_populated_fields", "countryName", "who_searched",
        "request_country", "method_name", "lib_postal_result", "parsed_request_quertystring", "developer_email",
        "house_number", "road", "city",
    }
]
KEYS = ", ".join(FIXTURE_KEYS)


def time_text(column: str, name: str) -> Column:
    """A time as text, to compare it without regard to the type it has in an engine."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def time_sql(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


DEVELOPER = "dev.metrics@example.com"


def hash_of(columns: list[str], *extra: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns] + [f"'{e}'" for e in extra]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


KEY_ORDER = f"search_query_counts DESC, {hash_of(FIXTURE_KEYS)}, " + ", ".join(f"{k} NULLS FIRST" for k in FIXTURE_KEYS)


def chosen_sql(ago: int | None, developer: str | None = DEVELOPER, full: bool = True) -> str:
    """Filtered logs with their country."""
    tests = ["lower(method_name) <> 'search 2 poisearch'"]
    if ago is not None:
        tests.append(f"client_received_start_timestamp > TIMESTAMP '{NOW}' - INTERVAL {ago} DAY")
    if developer is not None:
        tests.append(f"coalesce(lower(developer_email), '') <> '{developer}'")
    if full:
        tests.append("who_searched = 'Full Address Search'")
    return f"""
SELECT l.*, s.country_code AS country FROM search_logs l
JOIN (SELECT DISTINCT country_code, lower(spelling) AS sp FROM country_spellings) s ON lower(l.countryName) = s.sp
WHERE {' AND '.join(tests)}"""


def counted_sql(source: str, extra: str = "country") -> str:
    return f"SELECT {extra}, {KEYS}, count(*) AS search_query_counts FROM {source} GROUP BY {extra}, {KEYS}"


# Names of a pipe list put back together in order.
DECODED = """
SELECT populated_fields AS pf,
  coalesce((SELECT string_agg(m.populated_field_description, '|' ORDER BY i.pos)
            FROM (SELECT unnest(string_split(populated_fields, '|')) AS item,
                         generate_subscripts(string_split(populated_fields, '|'), 1) AS pos) i
            JOIN populated_fields_master m ON CAST(m.populated_field_id AS VARCHAR) = i.item), '') AS components,
  CAST(len(list_filter(string_split(populated_fields, '|'), lambda x : x <> '')) AS INTEGER) AS number_components
FROM (SELECT DISTINCT populated_fields FROM search_logs)"""


def finished_sql(source: str, extra: str = "") -> str:
    """Decoded, upper-cased, readable rows of a sample."""
    columns = ", ".join(f"upper({k}) AS {k}" if k == "countryName" else k for k in FIXTURE_KEYS)
    return f"""
SELECT country, {extra} {columns}, search_query_counts, d.components, d.number_components
FROM {source} s JOIN decoded d ON s.populated_fields = d.pf WHERE searched_query NOT LIKE '%�%'"""


def collapsed(column: str) -> str:
    return f"""regexp_replace(regexp_replace({column}, '''+', '''', 'g'), '"+', '"', 'g')"""


def extracted(text: str, key: str) -> str:
    return f"""regexp_extract({text}, '"{key}":"(.+?)"[,}}]', 1)"""


COMPONENTS = f"""
SELECT *, {', '.join(extracted('removed_air_quotes', k) + f' AS {c}' for k, c in COMPONENT_COLUMNS.items())}
FROM (SELECT *, {collapsed('lib_postal_result')} AS removed_air_quotes FROM search_logs)"""

_STRUCTURED = "method_name = 'search 2 structuredGeocode'"
_BY_COLUMN = {column: key for key, column in STRUCTURED_COLUMNS.items()}
STRUCTURED = f"""
SELECT * EXCLUDE (removed_air_quotes, raw, {', '.join(COMPONENT_COLUMNS.values())}), raw AS removed_air_quotes,
  {', '.join(f"CASE WHEN {_STRUCTURED} THEN {extracted('raw', _BY_COLUMN[c])} ELSE {c} END AS {c}" if c in _BY_COLUMN else c
             for c in COMPONENT_COLUMNS.values())}
FROM (SELECT *, {collapsed('parsed_request_quertystring')} AS raw FROM components)"""


def unescaped(text: str) -> str:
    for escape, plain in ALL_ESCAPES.items():
        plain = plain.replace("'", "''")
        text = f"replace({text}, '{escape}', '{plain}')"
    return text


COMMAS = f"""nullif(array_to_string(list_transform(list_filter([{', '.join(COMMA_PARTS)}], lambda x : x <> ''),
  lambda x : {unescaped('x')}), ', '), '')"""
SPACES = f"regexp_replace(replace(trim(concat_ws(' ', {', '.join(SPACED_PARTS)})), '%20', ' '), '\\s+', ' ', 'g')"


def rebuilt_sql(expression: str) -> str:
    return f"""
SELECT * EXCLUDE (searched_query), CASE WHEN {_STRUCTURED} THEN {expression} ELSE searched_query END AS searched_query
FROM structured"""


PARSE_STEPS = {"components": COMPONENTS, "structured": STRUCTURED}
PREPROCESS_STEPS = {**PARSE_STEPS, "rebuilt": rebuilt_sql(COMMAS)}


def reply_columns(threshold: float = 0.85) -> str:
    """First result of a response."""
    none = "json_array_length(response, '$.results') = 0"
    score = "CAST(json_extract(response, '$.results[0].matchConfidence.score') AS DOUBLE)"
    return f"""
CASE WHEN {none} THEN NULL ELSE json_extract_string(response, '$.summary.query') END AS original_formatted_query,
CASE WHEN {none} THEN -1.0 ELSE {score} END AS confidence,
CAST(json_extract(response, '$.results[0].position.lat') AS DOUBLE) AS lat,
CAST(json_extract(response, '$.results[0].position.lon') AS DOUBLE) AS lon,
json_extract_string(response, '$.results[0].type') AS query_type,
CASE WHEN {none} THEN NULL ELSE coalesce(CAST(json_extract(response, '$.results[0].boundingBox') AS VARCHAR), 'None') END AS bounding_box,
CAST(CASE WHEN {none} THEN -1 WHEN {score} > {threshold} THEN 1 ELSE 0 END AS INTEGER) AS match"""


# The cumulative Poisson(1) probabilities times 2^32, in hexadecimal.
POISSON_LIMITS = [
    "5e2d58d8", "bc5ab1b1", "eb715e1d", "fb239797", "ff1025f5", "ffd90f3b",
    "fffa8b71", "ffff540c", "ffffed1f", "fffffe21", "ffffffd4", "fffffffc",
]


def poisson_sql(draw: str) -> str:
    whens = " ".join(f"WHEN {draw} < '{limit}' THEN {k}" for k, limit in enumerate(POISSON_LIMITS))
    return f"CASE {whens} ELSE {len(POISSON_LIMITS)} END"


ESTIMATES = {
    "mean": "sum(w * above) / sum(w * below)", "ratio": "sum(w * above) / sum(w * below)",
    "sum": "sum(rows) * sum(w * above) / sum(w * rows)", "count": "sum(rows) * sum(w * below) / sum(w * rows)",
}


def bootstrap_steps(
    source: str, id_column: str, value: str, times: int, statistic: str = "mean", below: str | None = None,
) -> dict[str, str]:
    """Replicates over 16384 cells, four draws to each hash of cell, block and seed 0."""
    draw = "substr(md5(concat(CAST(cell AS VARCHAR), '-', CAST(t // 4 AS VARCHAR), '-0')), CAST(1 + 8 * (t % 4) AS INTEGER), 8)"
    return {
        "cells": f"""SELECT CAST(concat('0x', substr(md5(CAST({id_column} AS VARCHAR)), 1, 8)) AS BIGINT) % 16384 AS cell,
coalesce(sum({value}), 0) AS above, CAST({below or f'count({value})'} AS DOUBLE) AS below, CAST(count(*) AS DOUBLE) AS rows FROM {source} GROUP BY 1""",
        "weighted": f"SELECT t, above, below, rows, {poisson_sql(draw)} AS w FROM cells, (SELECT unnest(range({times})) AS t)",
        "replicates": f"SELECT t AS replicate, {ESTIMATES[statistic]} AS estimate FROM weighted GROUP BY t",
    }


_RESULT = "CAST(json_extract(api_results_json, '$[' || CAST(pos AS VARCHAR) || ']') AS VARCHAR)"
_ADDRESS = [
    "countrySecondarySubdivision", "streetNumber", "postalCode", "municipality", "countrySubdivision", "localName",
    "streetName", "countryCodeISO3", "countryCode", "municipalitySubdivision", "freeformAddress",
]


def poi_steps(available: str = "TRUE") -> dict[str, str]:
    """Flat rows of the points of interest whose results are there when `available` holds."""
    return {
        "poi_results": f"""
SELECT p.* EXCLUDE (api_results_json), CASE WHEN {available} THEN api_results_json END AS api_results_json FROM reference_pois p""",
        "poi_items": f"""
SELECT *, {_RESULT} AS item FROM (
  SELECT *, unnest(CASE WHEN coalesce(json_array_length(api_results_json), 0) = 0 THEN [NULL]
                   ELSE range(CAST(json_array_length(api_results_json) AS BIGINT)) END) AS pos FROM poi_results)""",
        "poi_flat": f"""
SELECT reference_id, sample_id, sample_run_id, importance_rank, search_rank, search_request_string, business_status, name,
  search_radius_m, search_group, lat AS ref_lat, lon AS ref_lon,
  replace(replace(replace(replace(replace(classification, '{{"', ''), '"}}', ''), '(', ''), ')', ''), '"', '') AS cat_subcat,
  string_split(replace(replace(replace(classification, '{{"(', ''), ')"}}', ''), '"', ''), ',')[1] AS category,
  string_split(replace(replace(replace(classification, '{{"(', ''), ')"}}', ''), '"', ''), ',')[-1] AS subcategory,
  CAST(pos AS INTEGER) AS api_search_rank,
  CASE WHEN item IS NOT NULL THEN concat('{{"id":"', json_extract_string(item, '$.id'), '","score":"', json_extract_string(item, '$.score'),
    '","poi":"', replace(CAST(json_extract(item, '$.poi') AS VARCHAR), '"', '\\"'),
    '","address":"', replace(CAST(json_extract(item, '$.address') AS VARCHAR), '"', '\\"'),
    '","position":"', replace(CAST(json_extract(item, '$.position') AS VARCHAR), '"', '\\"'), '"}}') END AS api_results,
  json_extract_string(item, '$.score') AS api_score, json_extract_string(item, '$.id') AS api_poi_id,
  json_extract_string(item, '$.position.lat') AS api_lat, json_extract_string(item, '$.position.lon') AS api_lon,
  {', '.join(f"json_extract_string(item, '$.address.{a}') AS api_{a}" for a in _ADDRESS)},
  json_extract_string(item, '$.poi.name') AS api_poiName, json_extract_string(item, '$.poi.url') AS api_poiURL,
  json_extract_string(item, '$.poi.brands[0].name') AS api_poiBrand, json_extract_string(item, '$.poi.phone') AS api_poiPhone,
  json_extract_string(item, '$.poi.categorySet[0].id') AS api_categoryId,
  json_extract_string(item, '$.poi.classifications[0].code') AS api_code,
  'tt' AS api_provider_id, CAST(NULL AS VARCHAR) AS api2_run_id
FROM poi_items""",
    }


DISTANCE = """round(2 * 6371008.8 * asin(sqrt(
  pow(sin(radians(CAST(api_lat AS DOUBLE) - ref_lat) / 2), 2)
  + cos(radians(ref_lat)) * cos(radians(CAST(api_lat AS DOUBLE))) * pow(sin(radians(CAST(api_lon AS DOUBLE) - ref_lon) / 2), 2))), 2)"""

AREA_OF_POINT = """
SELECT p.*, a.area_id, a.area_name FROM points p JOIN areas a
ON p.lat >= a.min_lat AND p.lat < a.max_lat AND p.lon >= a.min_lon AND p.lon < a.max_lon"""
