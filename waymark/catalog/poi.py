"""Points of interest, their retry rounds and their flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.pieces import DISTANCE, poi_steps
from waymark.catalog.registry import query
from waymark.fixtures import view
from waymark.functions.geocode import limit_results
from waymark.functions.poi import read_results, split_classification
from waymark.operators.reports import api_status_report, null_result_count
from waymark.plans.poi import poi_flatten, poi_table
from waymark.schemas import POI_COLUMNS
from waymark.streaming.retry import Filler, fill_if_null, read_rounds, retry_until_filled, start_unanswered

VIEWS = ["reference_pois"]
# The round in which the answers to a point of interest first come back.
ANSWERED_IN = "reference_id % 3 + 1"
# What the first round leaves behind.
FIRST_ROUND = {
    "filled": f"""
SELECT reference_id, 1 AS apiCalls, CASE WHEN {ANSWERED_IN} = 1 THEN api_results_json END AS api_results_json FROM reference_pois"""
}
N_RESULTS = "CAST(json_array_length(api_results_json) AS INTEGER) AS n_results"


def _pois(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "reference_pois").drop("api_results_json")


def _with_results(spark: SparkSession, sf: str) -> DataFrame:
    pois = view(spark, sf, "reference_pois")
    return pois.withColumn("apiResults", read_results(F.col("api_results_json"))).drop("api_results_json")


def _filler(spark: SparkSession, sf: str) -> Filler:
    answers = view(spark, sf, "reference_pois").select(
        "reference_id", F.expr(ANSWERED_IN).alias("_from"), read_results(F.col("api_results_json")).alias("found")
    )

    def fill(rows: DataFrame, number: int) -> DataFrame:
        return rows.join(answers.where(F.col("_from") <= number).drop("_from"), "reference_id", "left")

    return fill


def _first_round(spark: SparkSession, sf: str) -> DataFrame:
    return fill_if_null(start_unanswered(_pois(spark, sf)), _filler(spark, sf), 1)


def as_text(df: DataFrame) -> DataFrame:
    """Arrays and maps of the flat table as text."""
    return df.withColumns({"cat_subcat": F.array_join("cat_subcat", ","), "api_results": F.to_json("api_results")})


@query("fill_if_null", VIEWS, f"SELECT reference_id, apiCalls, {N_RESULTS} FROM filled", FIRST_ROUND)
def _fill(spark: SparkSession, sf: str) -> DataFrame:
    return _first_round(spark, sf).select("reference_id", "apiCalls", F.size("apiResults").alias("n_results"))


@query("api_status_report", VIEWS, """
SELECT CASE WHEN api_results_json IS NULL THEN 0 ELSE 1 END AS api_status, apiCalls, count(*) AS count FROM filled GROUP BY 1, 2""", FIRST_ROUND)
def _report(spark: SparkSession, sf: str) -> DataFrame:
    return api_status_report(_first_round(spark, sf))


@query("null_result_count", VIEWS, """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE api_results_json IS NULL) AS null_rows FROM filled""", FIRST_ROUND)
def _nulls(spark: SparkSession, sf: str) -> DataFrame:
    return null_result_count(_first_round(spark, sf))


@query("retry_until_filled", VIEWS, f"""
SELECT reference_id, CAST(CASE WHEN api_results_json IS NULL
  THEN (SELECT max({ANSWERED_IN}) FROM reference_pois WHERE api_results_json IS NOT NULL) + 1 ELSE {ANSWERED_IN} END AS INTEGER) AS apiCalls,
  {N_RESULTS}
FROM reference_pois""")
def _retry(spark: SparkSession, sf: str) -> DataFrame:
    pois = _pois(spark, sf)
    rounds = retry_until_filled(pois, _filler(spark, sf), stop_when_idle=True)
    return read_rounds(pois, rounds).select("reference_id", "apiCalls", F.size("apiResults").alias("n_results"))


@query("limit_results", VIEWS, """
SELECT reference_id, CASE WHEN json_array_length(api_results_json) > 0 THEN 1 END AS n_results,
  json_extract_string(api_results_json, '$[0].id') AS first_id FROM reference_pois""")
def _limit(spark: SparkSession, sf: str) -> DataFrame:
    limited = _with_results(spark, sf).select("reference_id", limit_results(F.col("apiResults"), 1).alias("_results"))
    return limited.select("reference_id", F.size("_results").alias("n_results"), F.get("_results", F.lit(0))["id"].alias("first_id"))


@query("classification_split", VIEWS, "SELECT DISTINCT reference_id, cat_subcat, category, subcategory FROM poi_flat", poi_steps())
def _classes(spark: SparkSession, sf: str) -> DataFrame:
    parts = split_classification(F.col("classification"))
    return view(spark, sf, "reference_pois").select("reference_id", parts.alias("_parts")).select(
        "reference_id", F.array_join("_parts", ",").alias("cat_subcat"), F.get("_parts", F.lit(0)).alias("category"),
        F.element_at("_parts", -1).alias("subcategory"),
    )


@query("poi_flatten", VIEWS, "SELECT * FROM poi_flat", poi_steps())
def _flatten(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(poi_flatten(_with_results(spark, sf)))


TABLE = f"SELECT {', '.join(f'{DISTANCE} AS {c}' if c == 'location_distance_m' else c for c in POI_COLUMNS)} FROM poi_flat"


def _table(pois: DataFrame) -> DataFrame:
    return as_text(poi_table(poi_flatten(pois))).withColumn("location_distance_m", F.round("location_distance_m", 2))


@query("poi_table_columns", VIEWS, TABLE, poi_steps())
def _columns(spark: SparkSession, sf: str) -> DataFrame:
    return _table(_with_results(spark, sf))


@query("haversine_m", VIEWS, f"SELECT reference_id, api_search_rank, {DISTANCE} AS distance_m FROM poi_flat", poi_steps())
def _distance(spark: SparkSession, sf: str) -> DataFrame:
    return _table(_with_results(spark, sf)).select(
        "reference_id", "api_search_rank", F.col("location_distance_m").alias("distance_m")
    )


@query("poi_pipeline", VIEWS, TABLE, poi_steps())
def _pipeline(spark: SparkSession, sf: str) -> DataFrame:
    pois = _pois(spark, sf)
    rounds = retry_until_filled(pois, _filler(spark, sf), stop_when_idle=True)
    return _table(read_rounds(pois, rounds))
