"""Points in areas, and providers compared."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from helpers import bag
from waymark.operators.areas import area_cells, locate
from waymark.operators.providers import (
    answered_by_request, compare_providers, level_columns, provider_fanout, provider_pivot, provider_unpivot, union_all,
)
from waymark.schemas import PROVIDERS


def random_areas(draw, n=40):
    areas = []
    for i in range(n):
        height, width = draw.choice([0.01, 0.3, 5.0, 60.0]), draw.choice([0.01, 0.3, 5.0, 120.0])
        low, left = draw.uniform(-90, 90 - height), draw.uniform(-180, 180 - width)
        areas.append((i, f"a{i}", low, low + height, left, left + width))
    return areas


PROVIDER_AREA = "provider_id string, country string, area_id int, area_name string, min_lat double, max_lat double, min_lon double, max_lon double"
AREA = "area_id int, area_name string, min_lat double, max_lat double, min_lon double, max_lon double"


@pytest.mark.parametrize("hot", [False, True])
def test_locate_against_brute_force(spark, request, hot):
    if hot:
        request.getfixturevalue("nothing_fits")
    draw = random.Random(4)
    areas = random_areas(draw) + [(99, "edge", 10.0, 20.0, 10.0, 20.0)]
    points = [(i, draw.uniform(-90, 90), draw.uniform(-180, 180)) for i in range(300)]
    points += [(300, 10.0, 10.0), (301, 20.0, 15.0), (302, 19.999, 19.999)] + [(i, 15.0, 15.0) for i in range(303, 330)]
    expected = Counter(
        (p[0], a[0]) for p in points for a in areas if a[2] <= p[1] < a[3] and a[4] <= p[2] < a[5]
    )
    made = locate(spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame(areas, AREA))
    assert bag(made, "id", "area_id") == expected
    cells = area_cells(spark.createDataFrame(areas, AREA)).groupBy("area_id").count().collect()
    assert max(r["count"] for r in cells) <= 4


def around(lon):
    return (lon + 180) % 360 - 180


def test_boxes_across_the_date_line_and_at_the_poles(spark):
    draw = random.Random(11)
    areas = [(0, "line", -1.0, 1.0, 179.9, -179.9), (1, "beyond", -1.0, 1.0, 179.0, 181.0), (2, "globe", -90.0, 90.0, -180.0, 180.0),
             (3, "turn", 0.0, 1.0, -200.0, 200.0), (4, "pole", 89.0, 90.0, 0.0, 90.0), (5, "edge", -1.0, 1.0, 170.0, 180.0),
             (6, "lost", None, 1.0, 0.0, 1.0), (7, "empty", 0.0, 0.0, 1.0, 2.0), (8, "west", -1.0, 1.0, -190.0, -170.0)]
    for i in range(10, 60):
        low, left, width = draw.uniform(-90, 80), draw.uniform(-180, 180), draw.choice([0.01, 0.5, 7.0, 200.0])
        areas.append((i, "a", low, low + draw.choice([0.01, 3.0, 10.0]), left, around(left + width)))
    points = [(i, draw.uniform(-90, 90), draw.choice([-1, 1]) * draw.uniform(160, 180)) for i in range(400)]
    points += [(400, 0.0, 180.0), (401, 0.0, -180.0), (402, 90.0, 10.0), (403, 0.5, 179.95), (404, 0.5, -179.95), (405, None, 1.0), (406, 0.5, 185.0), (407, -90.0, 5.0)]

    def inside(p, a):
        if p[1] is None or a[2] is None:
            return False
        if not (a[2] <= p[1] < a[3] or a[3] >= 90 and p[1] == 90):
            return False
        x, west, east = around(p[2]), a[4], a[5]
        if east - west >= 360:
            return True
        span = (east - west) % 360 if east != west else 0
        return (x - west) % 360 < span

    expected = Counter((p[0], a[0]) for p in points for a in areas if inside(p, a))
    boxes = spark.createDataFrame(areas, AREA)
    made = locate(spark.createDataFrame(points, "id int, lat double, lon double"), boxes)
    assert made.columns == ["id", "lat", "lon", "area_id", "area_name", "min_lat", "max_lat", "min_lon", "max_lon"]
    assert bag(made, "id", "area_id") == expected
    assert {(403, 0), (404, 0), (400, 0), (401, 1), (402, 4)} <= set(expected)
    assert max(r["count"] for r in area_cells(boxes).groupBy("area_id").count().collect()) <= 8


def test_upside_down_boxes_are_refused(spark):
    boxes = spark.createDataFrame([(1, "a", 2.0, 1.0, 0.0, 1.0)], AREA)
    with pytest.raises(Exception, match="min_lat above max_lat"):
        locate(points(spark).drop("country"), boxes).collect()


def test_small_boxes_share_no_large_cell(spark):
    tiles = [(i * 50 + j, "t", i / 100, (i + 1) / 100, j / 100, (j + 1) / 100) for i in range(50) for j in range(50)]
    cells = area_cells(spark.createDataFrame(tiles, AREA)).groupBy("_level", "_lat", "_lon").count()
    assert max(r["count"] for r in cells.collect()) <= 16


def points(spark):
    rows = [(i, 1.5, 2.5, "ES") for i in range(8)] + [(8, 50.0, 50.0, "FR"), (9, None, 1.0, "FR"), (10, 1.5, 2.5, None)]
    return spark.createDataFrame(rows, "id int, lat double, lon double, country string")


@pytest.mark.parametrize("hot", [False, True])
def test_comparison(spark, request, hot):
    if hot:
        request.getfixturevalue("nothing_fits")
    responses = spark.createDataFrame([("tt", 1.5, 2.5, "x"), ("gg", 50.0, 50.0, "y")], "provider_id string, lat double, lon double, results string")
    areas = spark.createDataFrame([
        ("or", "ES", 2, "outer", 0.0, 5.0, 0.0, 5.0), ("or", "ES", 1, "inner", 1.0, 5.0, 0.0, 5.0), ("os", "ES", 3, "own", 0.0, 5.0, 0.0, 5.0),
        ("mnr", "FR", 4, "abroad", 0.0, 5.0, 0.0, 5.0),
    ], PROVIDER_AREA)
    got = compare_providers(points(spark), responses, areas, ["tt", "gg", "or", "os", "mnr"])
    both = '[{"area_id":1,"area_name":"inner"},{"area_id":2,"area_name":"outer"}]'
    expected = Counter()
    for i in range(11):
        here = i < 8
        expected[(i, "tt", "x" if here or i == 10 else None)] += 1
        expected[(i, "gg", "y" if i == 8 else None)] += 1
        expected[(i, "or", both if here else None)] += 1
        expected[(i, "os", '[{"area_id":3,"area_name":"own"}]' if here else None)] += 1
        expected[(i, "mnr", None)] += 1
    assert bag(got, "id", "provider_id", "results") == expected
    assert bag(answered_by_request(points(spark), responses, ["he"]), "results") == Counter({(None,): 11})


def test_comparison_casts_text_coordinates(spark):
    texts = points(spark).selectExpr("id", "cast(lat as string) lat", "'bad' lon", "country")
    responses = spark.createDataFrame([], "provider_id string, lat double, lon double, results string")
    got = compare_providers(texts, responses, spark.createDataFrame([], PROVIDER_AREA), ["tt", "os"])
    assert got.count() == 22 and got.where("lon is not null").count() == 0


def test_wrong_providers_and_columns(spark):
    with pytest.raises(ValueError):
        provider_fanout(points(spark), ["xx"])
    with pytest.raises(ValueError):
        provider_fanout(points(spark), [])
    with pytest.raises(ValueError):
        compare_providers(points(spark).drop("lon"), points(spark), points(spark))
    with pytest.raises(ValueError):
        locate(points(spark).drop("lat"), points(spark))
    assert provider_fanout(points(spark)).count() == 11 * len(PROVIDERS)


def test_levels(spark):
    assert list(level_columns(["order_4", "country"], ["tt", "or"])) == ["order_4_tt", "country_tt", "order_4_or", "country_or"]
    assert list(level_columns(["l"], ["p"], "corrected")) == ["l_p_corrected"]
    wide = spark.createDataFrame([(1, "a", None), (2, "c", "d")], "id int, l_p_x string, l_q_x string")
    long = provider_unpivot(wide, "id", ["l"], ["p", "q"], "x")
    assert bag(long, "id", "level", "provider", "value") == Counter({
        (1, "l", "p", "a"): 1, (1, "l", "q", None): 1, (2, "l", "p", "c"): 1, (2, "l", "q", "d"): 1,
    })
    assert bag(provider_pivot(long, "id", ["l"], ["p", "q"], "x")) == bag(wide)


def test_union_by_name(spark):
    parts = [spark.createDataFrame([(1, "a")], "x int, y string"), spark.createDataFrame([("b", 2)], "z string, x int")]
    assert bag(union_all(parts), "x", "y", "z") == Counter({(1, "a", None): 1, (2, None, "b"): 1})
