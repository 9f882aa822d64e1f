"""Views shaped like the log, response and point-of-interest tables, derived from the given tables.

The same SQL text runs in Spark and in DuckDB, so queries and their oracles start from equal rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}

# The instant every look-back is taken from; the events end on 2024-01-30.
NOW = "2024-01-31 00:00:00"

VIEWS: dict[str, tuple[list[str], str]] = {}

VIEWS["search_logs"] = ([], """
WITH e AS (SELECT event_id, ts, user_id, user_id * 7 + event_id % 5 AS k FROM events),
j AS (SELECT e.*, n.n_nationkey, n.n_name FROM e JOIN customer c ON e.user_id = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT event_id AS log_id,
  ts AS client_received_start_timestamp,
  concat('/search/2/', CAST(k AS STRING), '.json') AS request_uri,
  CASE WHEN k % 29 = 0 THEN concat('bad � ', CAST(k AS STRING))
       ELSE concat(CAST(k % 90 + 1 AS STRING), ' street ', CAST(k % 37 AS STRING), ', city ', CAST(k % 20 AS STRING)) END AS searched_query,
  CASE k % 4 WHEN 0 THEN '|4|5|' WHEN 1 THEN '4|5|6' WHEN 2 THEN '1|4|5|6|9' ELSE '' END AS populated_fields,
  CASE k % 4 WHEN 0 THEN '4|5' WHEN 1 THEN '4|5|6' WHEN 2 THEN '1|4|5|6|9' ELSE '' END AS ordered_populated_fields,
  CASE WHEN event_id % 2 = 0 THEN n_name ELSE lower(n_name) END AS countryName,
  CASE WHEN k % 3 = 0 THEN 'Full Address Search' ELSE 'Partial Search' END AS who_searched,
  concat('N', CAST(n_nationkey AS STRING)) AS request_country,
  CASE k % 5 WHEN 0 THEN 'search 2 search' WHEN 1 THEN 'search 2 structuredGeocode' WHEN 2 THEN 'search 2 geocode'
             WHEN 3 THEN 'Search 2 poiSearch' ELSE 'search 2 nearbySearch' END AS method_name,
  CASE WHEN k % 13 = 0 THEN 'Dev.Metrics@example.com' WHEN k % 17 = 0 THEN '' WHEN k % 19 = 0 THEN NULL
       ELSE concat('u', CAST(user_id AS STRING), '@example.com') END AS developer_email,
  CASE WHEN k % 11 = 0 THEN concat('{"house":"","road":"street ', CAST(k % 37 AS STRING), '"}')
       WHEN k % 7 = 0 THEN concat('{""house_number"":""', CAST(k % 90 + 1 AS STRING), '"",""road"":""street ', CAST(k % 37 AS STRING), '""}')
       ELSE concat('{"house_number":"', CAST(k % 90 + 1 AS STRING), '","road":"street ', CAST(k % 37 AS STRING),
                   '","city":"city ', CAST(k % 20 AS STRING), '"}') END AS lib_postal_result,
  concat('{"streetNumber":"', CAST(k % 90 + 1 AS STRING), '","streetName":"street%20', CAST(k % 37 AS STRING),
         '","municipality":"city%2C', CAST(k % 20 AS STRING), '","countryCode":"N', CAST(n_nationkey AS STRING), '"}') AS parsed_request_quertystring,
  CAST(k % 90 + 1 AS STRING) AS house_number,
  concat('street ', CAST(k % 37 AS STRING)) AS road,
  concat('city ', CAST(k % 20 AS STRING)) AS city
FROM j""")

VIEWS["country_spellings"] = ([], """
SELECT concat('N', CAST(n_nationkey AS STRING)) AS country_code, n_name AS spelling FROM nation
UNION SELECT concat('N', CAST(n_nationkey AS STRING)), concat('Official ', n_name) FROM nation
UNION SELECT concat('N', CAST(n_nationkey AS STRING)), concat('N', CAST(n_nationkey AS STRING)) FROM nation""")

VIEWS["populated_fields_master"] = ([], """
SELECT n_nationkey AS populated_field_id,
  concat('field_', CAST(n_nationkey AS STRING)) AS populated_field_description FROM nation""")

VIEWS["geocode_responses"] = (["search_logs"], """
WITH q AS (SELECT searched_query, min(CAST(split_part(split_part(request_uri, '/', 4), '.', 1) AS INT)) AS k
           FROM search_logs GROUP BY searched_query)
SELECT searched_query,
  CASE WHEN k % 10 = 9 THEN concat('{"summary":{"query":"', lower(searched_query), '"},"results":[]}')
  ELSE concat('{"summary":{"query":"', lower(searched_query), '"},"results":[{"type":"Point Address","matchConfidence":{"score":0.',
         CAST(60 + k % 40 AS STRING), '},"position":{"lat":', CAST(30 + k % 20 AS STRING), '.5,"lon":-', CAST(60 + k % 30 AS STRING), '.25}',
         CASE WHEN k % 3 = 0 THEN ',"boundingBox":{"topLeftPoint":{"lat":1.5,"lon":2.5}}' ELSE '' END, '}]}') END AS response
FROM q""")

VIEWS["reference_pois"] = ([], """
SELECT s_suppkey AS reference_id, 1 AS sample_id, 1 AS sample_run_id, CAST(s_suppkey % 10 AS INT) AS importance_rank,
  CASE WHEN s_suppkey % 4 = 0 THEN '{"(food)"}' ELSE concat('{"(food,sub', CAST(s_suppkey % 3 AS STRING), ')"}') END AS classification,
  CAST(s_suppkey % 5 AS INT) AS search_rank, s_name AS search_request_string, 'OPERATIONAL' AS business_status, s_name AS name,
  CAST(40 + s_suppkey % 10 AS DOUBLE) AS lat, CAST(-3 - s_suppkey % 7 AS DOUBLE) AS lon, 500 AS search_radius_m, 'g1' AS search_group,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL
  ELSE concat('[{"id":"p', CAST(s_suppkey AS STRING), '","score":"2.5","poi":{"name":"', s_name,
         '","url":"u.example.com","phone":"1","brands":[{"name":"b1"}],"categorySet":[{"id":7315}],"classifications":[{"code":"CAFE"}]},',
         '"address":{"streetNumber":"1","streetName":"s","municipality":"m","countryCode":"ES"},"position":{"lat":40.5,"lon":-3.5}},',
         '{"id":"q', CAST(s_suppkey AS STRING), '","score":"1.5","poi":{"name":"z"},"address":{},"position":{"lat":41.5,"lon":-4.5}}]') END AS api_results_json
FROM supplier""")

VIEWS["areas"] = ([], """
SELECT n_nationkey AS area_id, n_name AS area_name,
  CAST(30 + (n_nationkey % 5) * 4 AS DOUBLE) AS min_lat, CAST(34 + (n_nationkey % 5) * 4 AS DOUBLE) AS max_lat,
  CAST(-90 + CAST(floor(n_nationkey / 5) AS INT) * 6 AS DOUBLE) AS min_lon, CAST(-84 + CAST(floor(n_nationkey / 5) AS INT) * 6 AS DOUBLE) AS max_lon
FROM nation""")

# Points on both sides of the date line and boxes across it, some with bounds beyond it.
VIEWS["ocean_points"] = ([], """
SELECT event_id AS id, CAST(-20 + event_id % 41 AS DOUBLE) + 0.25 AS lat,
  CASE WHEN event_id % 50 = 7 THEN 180.0 WHEN user_id % 2 = 0 THEN CAST(170 + event_id % 10 AS DOUBLE) + 0.5 ELSE CAST(-180 + event_id % 10 AS DOUBLE) + 0.5 END AS lon
FROM events""")

VIEWS["ocean_areas"] = ([], """
SELECT n_nationkey AS area_id, n_name AS area_name, CAST(-20 + n_nationkey AS DOUBLE) AS min_lat, CAST(-10 + 2 * n_nationkey AS DOUBLE) AS max_lat,
  CAST(171 + n_nationkey % 9 AS DOUBLE) AS min_lon, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 182 + n_nationkey % 7 ELSE -178 + n_nationkey % 7 END AS DOUBLE) AS max_lon
FROM nation""")

# Boxes of the map providers: they differ by provider, lie in each other by level, and belong to a country.
VIEWS["provider_areas"] = ([], " UNION ALL ".join(f"""
SELECT '{provider}' AS provider_id, concat('N', CAST(n_nationkey % 7 AS STRING)) AS country, n_nationkey * 10 + {number} AS area_id,
  concat('{provider} ', n_name, ' level {level}') AS area_name,
  CAST(30 + (n_nationkey % 5) * 4 + {level + shift} AS DOUBLE) AS min_lat, CAST(34 + (n_nationkey % 5) * 4 - {level} AS DOUBLE) AS max_lat,
  CAST(-90 + CAST(floor(n_nationkey / 5) AS INT) * 6 + {level} AS DOUBLE) AS min_lon,
  CAST(-84 + CAST(floor(n_nationkey / 5) AS INT) * 6 - {level} AS DOUBLE) AS max_lon FROM nation"""
    for number, (provider, level, shift) in enumerate([("mnr", 0, 0), ("mnr", 1, 0), ("os", 0, 1), ("os", 1, 1), ("or", 0, 0)])))

VIEWS["provider_levels"] = ([], """
SELECT c_custkey AS id, concat('R', CAST(c_nationkey % 5 AS STRING)) AS order_1_pa, concat('R', CAST(c_custkey % 5 AS STRING)) AS order_1_pb,
  concat('N', CAST(c_nationkey AS STRING)) AS country_pa,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('N', CAST(c_nationkey AS STRING)) END AS country_pb
FROM customer""")

VIEWS["country_indicator"] = ([], """
SELECT c_name AS country, concat('N', CAST(c_nationkey AS STRING)) AS iso_alpha, 2002 + 5 * CAST(c_custkey % 2 AS INT) AS year,
  CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE CAST(50 + c_custkey % 40 AS DOUBLE) END AS lifeExp FROM customer""")

# Points to be looked up: one per log row, so that a hot query is a hot point.
VIEWS["points"] = ([], """
SELECT event_id AS id, CAST(30 + user_id % 20 AS DOUBLE) + 0.5 AS lat, -(CAST(60 + user_id % 30 AS DOUBLE) + 0.25) AS lon,
  concat('N', CAST(user_id % 7 AS STRING)) AS country FROM events""")

# Answers of the request-based providers, at most one per provider and point.
VIEWS["provider_responses"] = (["points"], """
WITH p AS (SELECT DISTINCT lat, lon FROM points)
SELECT 'tt' AS provider_id, lat, lon, concat('{"road":"tt ', CAST(CAST(floor(lat) AS INT) AS STRING), '"}') AS results FROM p
UNION ALL SELECT 'he', lat, lon, concat('{"road":"he ', CAST(CAST(floor(lat) AS INT) AS STRING), '"}') FROM p WHERE lat < 45
UNION ALL SELECT 'gg', lat, lon, concat('{"road":"gg ', CAST(CAST(floor(lon) AS INT) AS STRING), '"}') FROM p WHERE lon < -65""")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """`sql` over the given tables, without leaving views behind in the session; `given` replaces some of the tables."""
    tables = {t: given[t] if t in given else read_table(spark, sf_dir, t) for t in BASE_TABLES if re.search(rf"\b{t}\b", sql)}
    text = sql.replace("{", "{{").replace("}", "}}")
    for table in tables:
        text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
    return spark.sql(text, **tables)


def _ordered(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for item in [*_ordered(VIEWS[name][0]), name]:
            if item not in ordered:
                ordered.append(item)
    return ordered


def with_views(names: list[str], body: str, steps: dict[str, str] | None = None) -> str:
    """`body` preceded by the views it names, in order of need, and by its own steps."""
    parts = {name: VIEWS[name][1] for name in _ordered(names)} | (steps or {})
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in parts.items()) + "\n" + body


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """One of the views above as a DataFrame over the tables in `sf_dir`."""
    return run_sql(spark, sf_dir, with_views([name], f"SELECT * FROM {name}"), **given)
