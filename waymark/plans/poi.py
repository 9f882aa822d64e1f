"""Reference points of interest with the results found for them, as one flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import haversine_m
from waymark.functions.poi import first_of, nested_map, split_classification
from waymark.schemas import POI_ADDRESS_FIELDS, POI_COLUMNS, POI_KEPT


def poi_flatten(pois: DataFrame, provider_id: str = "tt") -> DataFrame:
    """One row per reference and result, ranked from 0; a reference without results keeps one row."""
    exploded = pois.select(
        *POI_KEPT, F.col("lat").alias("ref_lat"), F.col("lon").alias("ref_lon"),
        split_classification(F.col("classification")).alias("cat_subcat"),
        F.posexplode_outer("apiResults").alias("api_search_rank", "api_results"),
    )
    read = exploded.select(
        "*", *[nested_map(F.col("api_results")[field]).alias(f"_{field}") for field in ("poi", "address", "position")]
    )
    poi, address, position = F.col("_poi"), F.col("_address"), F.col("_position")
    return read.select(
        *exploded.columns,
        F.get("cat_subcat", F.lit(0)).alias("category"),
        F.element_at("cat_subcat", -1).alias("subcategory"),
        F.col("api_results")["score"].alias("api_score"),
        F.col("api_results")["id"].alias("api_poi_id"),
        position["lat"].alias("api_lat"),
        position["lon"].alias("api_lon"),
        *[address[field].alias(f"api_{field}") for field in POI_ADDRESS_FIELDS],
        poi["name"].alias("api_poiName"),
        poi["url"].alias("api_poiURL"),
        first_of(poi["brands"], "name").alias("api_poiBrand"),
        poi["phone"].alias("api_poiPhone"),
        first_of(poi["categorySet"], "id").alias("api_categoryId"),
        first_of(poi["classifications"], "code").alias("api_code"),
        F.lit(provider_id).alias("api_provider_id"),
        F.lit(None).cast("string").alias("api2_run_id"),
    )


def poi_table(flat: DataFrame) -> DataFrame:
    """The flat rows with their distance from the reference, in the order of the saved table."""
    distance = haversine_m(
        F.col("ref_lat"), F.col("ref_lon"), F.col("api_lat").try_cast("double"), F.col("api_lon").try_cast("double")
    )
    return flat.withColumn("location_distance_m", distance).select(*POI_COLUMNS)
