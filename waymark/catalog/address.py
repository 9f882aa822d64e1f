"""Address components and rebuilt queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.pieces import PARSE_STEPS, PREPROCESS_STEPS, SPACES, rebuilt_sql, unescaped
from waymark.catalog.registry import query
from waymark.fixtures import view
from waymark.functions.address import comma_query, component_flags, parse_components, parse_structured, rebuild_queries
from waymark.functions.text import decode_escapes, rename_without_underscores, strip_underscores
from waymark.operators.dimensions import match_countries
from waymark.operators.stats import component_coverage
from waymark.plans.preprocess import preprocess
from waymark.schemas import ALL_ESCAPES, COMPONENT_COLUMNS, FLAG_COLUMNS
from waymark.session import new_path
from waymark.sources.sinks import write_parsed

LOGS = ["search_logs"]
PARTS = list(COMPONENT_COLUMNS.values())
PARSED = ["log_id", "searched_query", "removed_air_quotes", *PARTS]
FLAGS = ", ".join(
    f"coalesce({name} NOT IN ('', 'False', ' '), FALSE) AS {flag}" for name, flag in FLAG_COLUMNS.items()
)


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "search_logs")


@query("parse_components", LOGS, f"SELECT log_id, removed_air_quotes, {', '.join(PARTS)} FROM components", PARSE_STEPS)
def _components(spark: SparkSession, sf: str) -> DataFrame:
    return parse_components(_logs(spark, sf)).select("log_id", "removed_air_quotes", *PARTS)


@query("parse_structured", LOGS, f"SELECT log_id, removed_air_quotes, {', '.join(PARTS)} FROM structured", PARSE_STEPS)
def _structured(spark: SparkSession, sf: str) -> DataFrame:
    return parse_structured(parse_components(_logs(spark, sf))).select("log_id", "removed_air_quotes", *PARTS)


@query("structured_query_spaces", LOGS, "SELECT log_id, searched_query FROM rebuilt", {**PARSE_STEPS, "rebuilt": rebuilt_sql(SPACES)})
def _spaces(spark: SparkSession, sf: str) -> DataFrame:
    return rebuild_queries(parse_structured(parse_components(_logs(spark, sf))), "spaces").select("log_id", "searched_query")


@query("structured_query_commas", LOGS, "SELECT log_id, searched_query AS rebuilt_query FROM rebuilt WHERE method_name = 'search 2 structuredGeocode'", PREPROCESS_STEPS)
def _commas(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_structured(parse_components(_logs(spark, sf).where(F.col("method_name") == "search 2 structuredGeocode")))
    return parsed.select("log_id", comma_query(escapes=ALL_ESCAPES).alias("rebuilt_query"))


@query("rebuild_queries", LOGS, "SELECT log_id, method_name, searched_query FROM rebuilt", PREPROCESS_STEPS)
def _rebuild(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_structured(parse_components(_logs(spark, sf)))
    return rebuild_queries(parsed).select("log_id", "method_name", "searched_query")


@query("url_decode_subset", LOGS, f"SELECT log_id, {unescaped('parsed_request_quertystring')} AS decoded FROM search_logs")
def _escapes(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).select("log_id", decode_escapes(F.col("parsed_request_quertystring"), ALL_ESCAPES).alias("decoded"))


@query("component_flags", LOGS, f"SELECT log_id, {FLAGS} FROM structured", PARSE_STEPS)
def _flags(spark: SparkSession, sf: str) -> DataFrame:
    return component_flags(parse_structured(parse_components(_logs(spark, sf)))).select("log_id", *FLAG_COLUMNS.values())


@query("component_coverage", ["search_logs", "country_spellings"], f"""
SELECT s.country_code AS country, count(*) AS rows, {', '.join(f'CAST(sum(CAST({f} AS INTEGER)) AS BIGINT) AS {f}' for f in FLAG_COLUMNS.values())}
FROM flags f JOIN (SELECT DISTINCT country_code, lower(spelling) AS sp FROM country_spellings) s ON lower(f.countryName) = s.sp
GROUP BY s.country_code""", {**PARSE_STEPS, "flags": f"SELECT countryName, {FLAGS} FROM structured"})
def _coverage(spark: SparkSession, sf: str) -> DataFrame:
    matched = match_countries(_logs(spark, sf), view(spark, sf, "country_spellings"))
    return component_coverage(component_flags(parse_structured(parse_components(matched))))


@query("preprocess", LOGS, f"SELECT {', '.join(PARSED)} FROM rebuilt", PREPROCESS_STEPS)
def _preprocess(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess(_logs(spark, sf)).select(*PARSED)


@query("parsed_sink_roundtrip", LOGS, f"SELECT {', '.join(PARSED)} FROM rebuilt", PREPROCESS_STEPS)
def _parsed_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "parsed")
    write_parsed(preprocess(_logs(spark, sf)).select(*PARSED), path)
    return spark.read.parquet(path)


@query("strip_underscores", ["search_logs"], """
SELECT log_id, regexp_replace(label, '^_+', '') AS label FROM (
  SELECT log_id, concat(repeat('_', CAST(log_id % 4 AS INTEGER)), method_name, '_x') AS label FROM search_logs)""")
def _underscores(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.expr("repeat('_', CAST(log_id % 4 AS INT))")
    labelled = _logs(spark, sf).select(
        F.col("log_id").alias("__log_id"), strip_underscores(F.concat(lead, F.col("method_name"), F.lit("_x"))).alias("_label")
    )
    return rename_without_underscores(labelled)
