"""Geocoder responses, requests and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.pieces import reply_columns
from waymark.catalog.registry import query
from waymark.fixtures import view
from waymark.functions.geocode import read_response, result_columns
from waymark.operators.filters import confident
from waymark.plans.geocoding import geocode_enrich, geocode_results, request_table
from waymark.session import new_path

VIEWS = ["search_logs", "geocode_responses"]
PARSED = {"replies": f"SELECT searched_query, {reply_columns()} FROM geocode_responses"}
NUMBERED = "SELECT row_number() OVER (ORDER BY log_id) - 1 AS id, searched_query, method_name FROM search_logs"
RESULTS = f"""
SELECT original_formatted_query, confidence, lat, lon, query_type, id, bounding_box, searched_query, match
FROM ({NUMBERED}) n JOIN replies r USING (searched_query)
WHERE method_name <> 'search 2 nearbySearch' AND confidence >= 0.85"""


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "geocode_responses")


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "search_logs")


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    read = _responses(spark, sf).select("searched_query", read_response(F.col("response"), strict=True).alias("_reply"))
    return read.select("searched_query", *[c.alias(n) for n, c in result_columns(F.col("_reply")).items()])


@query("geocode_parse", VIEWS, "SELECT * FROM replies", PARSED)
def _parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf)


@query("filter_confidence", VIEWS, "SELECT searched_query, confidence, match FROM replies WHERE confidence >= 0.85", PARSED)
def _confident(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).where(confident(0.85)).select("searched_query", "confidence", "match")


@query("geocode_enrich", VIEWS, """
SELECT log_id, searched_query, original_formatted_query, confidence, lat, lon, query_type, bounding_box, match
FROM search_logs JOIN replies USING (searched_query)""", PARSED)
def _enrich(spark: SparkSession, sf: str) -> DataFrame:
    rows = _logs(spark, sf).select("log_id", "searched_query")
    return geocode_enrich(rows, _responses(spark, sf), id_column="log_id")


@query("geocode_results", VIEWS, RESULTS, PARSED)
def _results(spark: SparkSession, sf: str) -> DataFrame:
    return geocode_results(_logs(spark, sf), _responses(spark, sf), ["log_id"])


@query("result_csv_roundtrip", VIEWS, RESULTS, PARSED)
def _csv(spark: SparkSession, sf: str) -> DataFrame:
    return geocode_results(_logs(spark, sf), _responses(spark, sf), ["log_id"], save_path=new_path(spark, "results"))


@query("request_table", ["search_logs"], """
SELECT DISTINCT searched_query, country, concat(CASE WHEN country = 'kr' THEN 'https://kr.geocoder.example' ELSE 'https://geocoder.example' END,
  '/search/2/geocode/', url_encode(searched_query), '.json?limit=5') AS request_url
FROM (SELECT searched_query, CASE WHEN request_country = 'N3' THEN 'kr' ELSE lower(request_country) END AS country FROM search_logs)""")
def _requests(spark: SparkSession, sf: str) -> DataFrame:
    country = F.when(F.col("request_country") == "N3", "kr").otherwise(F.lower("request_country"))
    logs = _logs(spark, sf).select("searched_query", country.alias("country"))
    return request_table(logs, "https://geocoder.example", "https://kr.geocoder.example")


HOSTS = ("https://geocoder.example", "https://kr.geocoder.example")
LOCAL_HOST = "CASE WHEN country = 'kr' THEN 'https://kr.geocoder.example' ELSE 'https://geocoder.example' END"
PLACES_SQL = "SELECT lat, lon, CASE WHEN country = 'N3' THEN 'kr' ELSE lower(country) END AS country FROM points"
REVERSE = f"""
SELECT DISTINCT lat, lon, country, concat({LOCAL_HOST}, '/search/2/reverseGeocode/', CAST(lat AS VARCHAR), '%2C', CAST(lon AS VARCHAR),
  '.json?limit=5') AS request_url FROM ({PLACES_SQL})"""


def _places(spark: SparkSession, sf: str) -> DataFrame:
    country = F.when(F.col("country") == "N3", "kr").otherwise(F.lower("country"))
    return view(spark, sf, "points").select("lat", "lon", country.alias("country"))


@query("request_table_reverse", ["points"], REVERSE)
def _reverse(spark: SparkSession, sf: str) -> DataFrame:
    return request_table(_places(spark, sf), *HOSTS, call_type="reverseGeocode")


@query("request_table_full_reverse", ["points"], REVERSE)
def _full_reverse(spark: SparkSession, sf: str) -> DataFrame:
    return request_table(_places(spark, sf), *HOSTS, call_type="fullReverseGeocode")


@query("request_table_poi", ["reference_pois"], """
SELECT DISTINCT name, lat, lon, search_radius_m, concat('https://geocoder.example/search/2/poiSearch/', url_encode(name),
  '.json?limit=5&openingHours=nextSevenDays&relatedPois=all&lat=', CAST(lat AS VARCHAR), '&lon=', CAST(lon AS VARCHAR),
  '&radius=', CAST(search_radius_m AS VARCHAR)) AS request_url FROM reference_pois""")
def _poi_requests(spark: SparkSession, sf: str) -> DataFrame:
    return request_table(view(spark, sf, "reference_pois"), HOSTS[0], call_type="poiSearch")
