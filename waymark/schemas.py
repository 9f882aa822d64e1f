"""Column lists and schemas of the log, result and point-of-interest tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRUCTURED_ENDPOINT = "search 2 structuredGeocode"
NEARBY_ENDPOINT = "search 2 nearbySearch"
POI_ENDPOINT = "search 2 poiSearch"
FULL_ADDRESS = "Full Address Search"

# The columns one logged request is identified by.
LOG_KEYS = [
    "request_uri", "searched_query", "populated_fields", "ordered_populated_fields", "countryName",
    "who_searched", "request_country", "method_name", "lib_postal_result", "parsed_request_quertystring",
    "developer_email", "house", "near", "house_number", "road", "unit", "level", "entrance", "staircase",
    "po_box", "postcode", "suburb", "city_district", "city", "island", "state_district", "state",
    "country_region", "world_region",
]

# The columns of a saved country sample.
SAMPLE_COLUMNS = [
    "request_uri", "searched_query", "populated_fields", "countryName", "who_searched", "request_country",
    "method_name", "lib_postal_result", "parsed_request_quertystring", "developer_email",
    "search_query_counts", "country", "components", "number_components",
]

# Component key in the parser output -> column it is read into.
COMPONENT_COLUMNS = {
    "house": "lp_building_name",
    "near": "lp_near",
    "house_number": "lp_house_number",
    "road": "lp_road",
    "unit": "lp_unit",
    "level": "lp_floor",
    "staircase": "lp_staircase",
    "entrance": "lp_entrance",
    "postcode": "lp_postal_code",
    "po_box": "lp_po_box",
    "suburb": "lp_suburb",
    "city_district": "lp_city_district",
    "city": "lp_city",
    "island": "lp_island",
    "state_district": "lp_state_district",
    "state": "lp_state",
    "country_region": "lp_country_region",
    "country": "lp_country",
    "world_region": "lp_world_region",
}

# Key of a structured request -> component column it overwrites.
STRUCTURED_COLUMNS = {
    "streetNumber": "lp_house_number",
    "streetName": "lp_road",
    "postalCode": "lp_postal_code",
    "municipalitySubdivision": "lp_suburb",
    "municipality": "lp_city",
    "countrySecondarySubdivision": "lp_state_district",
    "countrySubdivision": "lp_state",
    "countryCode": "lp_country",
}

# Parts of a query rebuilt with spaces (all but the world region) and with commas.
SPACED_PARTS = [c for c in COMPONENT_COLUMNS.values() if c != "lp_world_region"]
COMMA_PARTS = list(STRUCTURED_COLUMNS.values())

# Component column -> presence flag, where the name is not simply has_<part>.
FLAG_COLUMNS = {
    c: "has_house_num" if c == "lp_house_number" else "has_" + c.removeprefix("lp_")
    for c in COMPONENT_COLUMNS.values()
}

# Escapes decoded in rebuilt queries, in the order they are replaced.
ESCAPES = {"%2C": ",", "%20": " ", "%3A": ":", "%27": "'"}
# These are decoded besides where any escape may occur.
ALL_ESCAPES = {**ESCAPES, "%28": "(", "%29": ")"}

# The fields of a response that are read.
RESPONSE_SCHEMA = T.StructType([
    T.StructField("summary", T.StructType([T.StructField("query", T.StringType())])),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("matchConfidence", T.StructType([T.StructField("score", T.DoubleType())])),
        T.StructField("position", T.StructType([
            T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
        ])),
        T.StructField("boundingBox", T.StringType()),
    ]))),
])

TEXT_MAP = T.MapType(T.StringType(), T.StringType())
RESULT_LIST = T.ArrayType(TEXT_MAP)

# Columns of a reference point that its rows keep.
POI_KEPT = [
    "reference_id", "sample_id", "sample_run_id", "importance_rank", "search_rank", "search_request_string",
    "business_status", "name", "search_radius_m", "search_group",
]

# Address fields read from one point-of-interest result.
POI_ADDRESS_FIELDS = [
    "countrySecondarySubdivision", "streetNumber", "postalCode", "municipality", "countrySubdivision",
    "localName", "streetName", "countryCodeISO3", "countryCode", "municipalitySubdivision", "freeformAddress",
]

# Column order of the saved point-of-interest table.
POI_COLUMNS = [
    "api2_run_id", "sample_id", "sample_run_id", "reference_id", "importance_rank", "search_rank",
    "search_request_string", "business_status", "name", "cat_subcat", "category", "subcategory", "ref_lat",
    "ref_lon", "search_radius_m", "location_distance_m", "search_group", "api_provider_id", "api_score",
    "api_search_rank", "api_poi_id", "api_lat", "api_lon",
    *[f"api_{field}" for field in POI_ADDRESS_FIELDS],
    "api_poiName", "api_poiURL", "api_poiBrand", "api_poiPhone", "api_categoryId", "api_code", "api_results",
]

# Reverse-geocoding providers. Map providers answer from area tables, the others by request.
PROVIDERS = ["tt", "he", "os", "or", "gg", "bg", "mnr"]
AREA_PROVIDERS = ["mnr", "os", "or"]
