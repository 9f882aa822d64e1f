"""Component extraction, rebuilt queries and flags."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.functions.address import (
    comma_query, component_flags, parse_components, parse_structured, rebuild_queries, spaced_query,
)
from waymark.functions.text import (
    decode_escapes, geocode_url, percent_encode, poi_url, rename_without_underscores, reverse_url, strip_underscores,
)
from waymark.plans.preprocess import preprocess
from waymark.schemas import ALL_ESCAPES, COMMA_PARTS, COMPONENT_COLUMNS, FLAG_COLUMNS, SPACED_PARTS


def components(spark, text):
    return parse_components(spark.createDataFrame([(text,)], "lib_postal_result string")).first()


@pytest.mark.parametrize("text, expected", [
    ('{""house"":""Empire"",""house_number"":""23 b""}', {"lp_building_name": "Empire", "lp_house_number": "23 b"}),
    ('{"house":"","road":"x"}', {"lp_building_name": ',"road":"x', "lp_road": "x"}),
    ('{"house": "a"}', {"lp_building_name": ""}),
    ('{"road":"a\nb"}', {"lp_road": ""}),
    ('{"road":"a\rb"}', {"lp_road": "a\rb"}),
    ('{"road":"a b"}', {"lp_road": "a b"}),
    ('{"road":"x","road":"y"}', {"lp_road": "x"}),
    ("{\"road\":\"l''avenue\"}", {"lp_road": "l'avenue"}),
    ('{"country_region":"r","country":"c","world_region":"w"}',
     {"lp_country_region": "r", "lp_country": "c", "lp_world_region": "w"}),
])
def test_components(spark, text, expected):
    row = components(spark, text)
    assert {name: row[name] for name in expected} == expected


def test_missing_components_are_empty_and_null_text_is_null(spark):
    assert set(components(spark, "no json").asDict()[c] for c in COMPONENT_COLUMNS.values()) == {""}
    assert set(components(spark, None).asDict()[c] for c in COMPONENT_COLUMNS.values()) == {None}


PIECES = st.sampled_from(['"', "'", ",", "}", ":", "\n", "\r", " ", "a", "é", '"road":"', '"city":"', '","'])


def test_components_match_python_on_random_text(spark):
    texts: list[str] = []

    @settings(max_examples=200, database=None, deadline=None)
    @given(st.lists(PIECES, max_size=25).map("".join))
    def collect(text):
        texts.append(text)

    collect()

    def expected(text, key):
        cleaned = re.sub('"+', '"', re.sub("'+", "'", text))
        found = re.search(f'"{key}":"(.+?)(?=")"[,}}]', cleaned)
        return found.group(1) if found else ""

    rows = parse_components(spark.createDataFrame([(t,) for t in texts], "lib_postal_result string")).collect()
    for row in rows:
        assert row["lp_road"] == expected(row["lib_postal_result"], "road")
        assert row["lp_city"] == expected(row["lib_postal_result"], "city")


def structured_rows(spark):
    return spark.createDataFrame([
        (1, "search 2 structuredGeocode", "old", '{"city":"lp"}', '{"streetNumber":"5","streetName":"a%20b","countryCode":"ES"}'),
        (2, "search 2 structuredGeocode", "old", '{"suburb":"s"}', "{}"),
        (3, "search 2 search", "kept", '{"city":"lp"}', '{"municipality":"other"}'),
        (4, None, "kept", '{"city":"lp"}', "{}"),
    ], "id int, method_name string, searched_query string, lib_postal_result string, parsed_request_quertystring string")


def test_structured_components_overwrite_eight_parts_of_structured_rows(spark):
    rows = {r["id"]: r for r in parse_structured(parse_components(structured_rows(spark))).collect()}
    assert (rows[1]["lp_house_number"], rows[1]["lp_road"], rows[1]["lp_city"]) == ("5", "a%20b", "")
    assert (rows[3]["lp_city"], rows[3]["removed_air_quotes"]) == ("lp", '{"municipality":"other"}')
    assert rows[2]["lp_suburb"] == "" and rows[4]["lp_city"] == "lp"


def test_rebuilt_queries(spark):
    rows = {r["id"]: r["searched_query"] for r in preprocess(structured_rows(spark)).collect()}
    assert rows == {1: "5, a b, ES", 2: None, 3: "kept", 4: "kept"}
    spaced = {r["id"]: r["searched_query"] for r in preprocess(structured_rows(spark), "spaces").collect()}
    assert spaced == {1: "5 a b ES", 2: "", 3: "kept", 4: "kept"}
    assert {r["searched_query"] for r in preprocess(structured_rows(spark), "none").collect()} == {"old", "kept"}
    with pytest.raises(ValueError):
        rebuild_queries(structured_rows(spark), "tabs")


def test_spaced_query_strips_before_it_decodes(spark):
    parts = {p: "" for p in SPACED_PARTS} | {"lp_building_name": "%20a 　b", "lp_country": "c \x1c"}
    row = spark.createDataFrame([parts]).select(spaced_query().alias("q")).first()
    text = " ".join(parts[p] for p in SPACED_PARTS)
    assert row["q"] == re.sub(r"\s+", " ", text.strip().replace("%20", " "))


def test_comma_query_skips_empty_parts_and_lower_case_escapes(spark):
    parts = {p: "" for p in COMMA_PARTS} | {"lp_road": "a%2Cb%2cc", "lp_city": "%28d%29"}
    df = spark.createDataFrame([parts])
    assert df.select(comma_query(escapes=ALL_ESCAPES).alias("q")).first()["q"] == "a,b%2cc, (d)"
    assert df.select(comma_query().alias("q")).first()["q"] == "a,b%2cc, %28d%29"


def test_escapes_are_replaced_in_order(spark):
    df = spark.createDataFrame([("%252C",)], "t string")
    first = df.select(decode_escapes(F.col("t"), {"%25": "%", "%2C": ","}).alias("x")).first()["x"]
    last = df.select(decode_escapes(F.col("t"), {"%2C": ",", "%25": "%"}).alias("x")).first()["x"]
    assert (first, last) == (",", "%2C")


def test_flags(spark):
    values = ["", " ", "False", None, "x"]
    df = spark.createDataFrame([(v,) * 19 for v in values], ", ".join(f"{c} string" for c in COMPONENT_COLUMNS.values()))
    rows = component_flags(df).collect()
    assert len(FLAG_COLUMNS) == 19 and FLAG_COLUMNS["lp_house_number"] == "has_house_num"
    for flag in FLAG_COLUMNS.values():
        assert [r[flag] for r in rows] == [False, False, False, False, True]


def test_underscores(spark):
    df = spark.createDataFrame([("__a_b_", "_")], "_x string, y string")
    assert df.select(strip_underscores(F.col("_x")).alias("v")).first()["v"] == "a_b_"
    assert rename_without_underscores(df).columns == ["x", "y"]
    with pytest.raises(ValueError):
        rename_without_underscores(spark.createDataFrame([(1, 2)], "_x int, x int"))


def test_request_addresses(spark):
    from urllib.parse import quote

    texts = ["a b/c", "ñ,é~*+", "�", "x%20"]
    df = spark.createDataFrame([(t, "kr" if i else "es") for i, t in enumerate(texts)], "q string, c string")
    rows = df.select("q", "c", percent_encode(F.col("q")).alias("e"), geocode_url(F.col("q"), F.col("c"), "h", "k", 5).alias("u")).collect()
    for row in rows:
        assert row["e"] == quote(row["q"], safe="")
        host = "k" if row["c"] == "kr" else "h"
        assert row["u"] == f"{host}/search/2/geocode/{quote(row['q'], safe='')}.json?limit=5"
    point = spark.createDataFrame([(1.5, -2.25, 500, "kr", "a b")], "lat double, lon double, r int, c string, n string")
    made = point.select(
        reverse_url(F.col("lat"), F.col("lon"), F.col("c"), "h", "k").alias("a"),
        poi_url(F.col("n"), F.col("lat"), F.col("lon"), F.col("r"), "h", 3).alias("b"),
    ).first()
    assert made["a"] == "k/search/2/reverseGeocode/1.5%2C-2.25.json?limit=50"
    assert made["b"] == "h/search/2/poiSearch/a%20b.json?limit=3&openingHours=nextSevenDays&relatedPois=all&lat=1.5&lon=-2.25&radius=500"
