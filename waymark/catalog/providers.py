"""Providers compared on the same points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.pieces import AREA_OF_POINT
from waymark.catalog.registry import query
from waymark.fixtures import view
from waymark.operators.areas import locate
from waymark.operators.providers import (
    answered_by_request, compare_providers, provider_fanout, provider_pivot, provider_unpivot, union_all,
)
from waymark.schemas import AREA_PROVIDERS, PROVIDERS
from waymark.session import new_path
from waymark.sources.sinks import write_country_results

LEVELS, PAIR = ["order_1", "country"], ["pa", "pb"]
FANNED = f"SELECT p.*, u.provider_id FROM points p, (SELECT unnest({PROVIDERS}) AS provider_id) u"
AREA_JSON = """concat('{"area_id":', CAST(a.area_id AS VARCHAR), ',"area_name":"', a.area_name, '"}')"""
COMPARED = {
    "fanned": FANNED,
    "in_areas": f"""
SELECT p.id, a.provider_id, concat('[', string_agg({AREA_JSON}, ',' ORDER BY a.area_id), ']') AS listed
FROM points p JOIN provider_areas a ON p.country = a.country
  AND p.lat >= a.min_lat AND p.lat < a.max_lat AND p.lon >= a.min_lon AND p.lon < a.max_lon
GROUP BY p.id, a.provider_id""",
    "compared": f"""
SELECT f.id, f.lat, f.lon, f.country, f.provider_id,
  CASE WHEN f.provider_id IN ({', '.join(f"'{p}'" for p in AREA_PROVIDERS)}) THEN l.listed ELSE r.results END AS results
FROM fanned f LEFT JOIN provider_responses r ON f.provider_id = r.provider_id AND f.lat = r.lat AND f.lon = r.lon
LEFT JOIN in_areas l ON f.id = l.id AND f.provider_id = l.provider_id""",
}
COMPARED_VIEWS = ["points", "provider_responses", "provider_areas"]


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points")


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    return compare_providers(_points(spark, sf), view(spark, sf, "provider_responses"), view(spark, sf, "provider_areas"))


@query("reverse_lookup", ["points", "areas"], "SELECT id, lat, lon, area_id, area_name FROM located", {"located": AREA_OF_POINT})
def _lookup(spark: SparkSession, sf: str) -> DataFrame:
    return locate(_points(spark, sf), view(spark, sf, "areas")).select("id", "lat", "lon", "area_id", "area_name")


@query("reverse_lookup_date_line", ["ocean_points", "ocean_areas"], """
SELECT id, p.lat, p.lon, area_id, area_name FROM ocean_points p JOIN ocean_areas a ON p.lat >= min_lat AND p.lat < max_lat
  AND (p.lon + 360) % 360 >= min_lon AND (p.lon + 360) % 360 < (max_lon + 360) % 360""")
def _lookup_ocean(spark: SparkSession, sf: str) -> DataFrame:
    located = locate(view(spark, sf, "ocean_points"), view(spark, sf, "ocean_areas"))
    return located.select("id", "lat", "lon", "area_id", "area_name")


@query("provider_fanout", ["points", "provider_responses"], """
SELECT f.*, r.results FROM fanned f
LEFT JOIN provider_responses r ON f.provider_id = r.provider_id AND f.lat = r.lat AND f.lon = r.lon""", {"fanned": FANNED})
def _fanout(spark: SparkSession, sf: str) -> DataFrame:
    return answered_by_request(_points(spark, sf), view(spark, sf, "provider_responses"), PROVIDERS)


@query("union_providers", ["points", "provider_responses", "areas"], """
SELECT p.id, 'tt' AS provider_id, r.results, NULL AS area_name FROM points p
JOIN provider_responses r ON r.provider_id = 'tt' AND p.lat = r.lat AND p.lon = r.lon
UNION ALL SELECT id, 'mnr', NULL, area_name FROM located""", {"located": AREA_OF_POINT})
def _union(spark: SparkSession, sf: str) -> DataFrame:
    points = _points(spark, sf)
    by_request = answered_by_request(points, view(spark, sf, "provider_responses"), ["tt"]).select("id", "provider_id", "results")
    by_area = provider_fanout(locate(points, view(spark, sf, "areas")), ["mnr"]).select("id", "area_name", "provider_id")
    return union_all([by_request, by_area])


@query("provider_compare", COMPARED_VIEWS, "SELECT * FROM compared", COMPARED)
def _compare(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf)


@query("country_status", COMPARED_VIEWS, """
SELECT c.country, CASE WHEN count(p.id) > 0 THEN 'Done' ELSE 'Incomplete' END AS status
FROM (SELECT unnest(['N1', 'N2', 'N5', 'ZZ']) AS country) c LEFT JOIN compared p ON p.country = c.country GROUP BY c.country""", COMPARED)
def _status(spark: SparkSession, sf: str) -> DataFrame:
    return write_country_results(_compared(spark, sf), ["N1", "N2", "N5", "ZZ"], new_path(spark, "compared"))


@query("provider_unpivot", ["provider_levels"], " UNION ALL ".join(
    f"SELECT id, '{level}' AS level, '{provider}' AS provider, {level}_{provider} AS value FROM provider_levels"
    for provider in PAIR for level in LEVELS
))
def _unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return provider_unpivot(view(spark, sf, "provider_levels"), "id", LEVELS, PAIR)


@query("provider_pivot", ["provider_levels"], "SELECT id, order_1_pa, country_pa, order_1_pb, country_pb FROM provider_levels")
def _pivot(spark: SparkSession, sf: str) -> DataFrame:
    return provider_pivot(provider_unpivot(view(spark, sf, "provider_levels"), "id", LEVELS, PAIR), "id", LEVELS, PAIR)
