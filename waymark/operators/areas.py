"""Points looked up in boxes, as an equi-join on grid cells.

Each grid level has cells four times as wide as the one below. A box is filed at the least level whose
cells are as large as the box, so it touches at most four cells, and a cell holds few boxes that do not
overlap; a point asks for its cell at each level in use. So neither large boxes nor a crowd of small ones
makes the join fan out. A box across the date line is filed as its two parts, which have at most eight cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators.joins import measures, salted_join, within_bounds

STEP = 4.0
# Cells of two metres; with the whole globe at level 5 there are fourteen levels.
LEAST_LEVEL = -8


def _cell(value: str) -> Column:
    return F.floor(F.col(value) / F.pow(F.lit(STEP), F.col("_level"))).cast("int")


def _eastward(lon: Column) -> Column:
    """The same meridian from -180 on and below 180."""
    return F.when(lon >= 180, lon - 360).when(lon < -180, lon + 360).otherwise(lon)


def _parts(areas: DataFrame) -> DataFrame:
    """Boxes with the western and eastern bound of each of their parts on one side of the date line."""
    west, past = F.col("min_lon"), F.col("max_lon")
    start, end = _eastward(west), F.when((past > 180) | (past < -180), _eastward(past)).otherwise(past)
    globe = past - west >= 360

    def part(a: Column, b: Column) -> Column:
        return F.struct(a.cast("double").alias("_west"), b.cast("double").alias("_east"))

    sides = F.when(globe, F.array(part(F.lit(-180), F.lit(180)))).when(start <= end, F.array(part(start, end))).otherwise(
        F.array(part(start, F.lit(180)), part(F.lit(-180), end))
    )
    upside = F.raise_error(F.concat(F.lit("area with min_lat above max_lat: "), F.to_json(F.struct("min_lat", "max_lat"))))
    checked = F.when(F.col("min_lat") > F.col("max_lat"), upside.cast("double")).otherwise(F.col("min_lat"))
    return areas.select("*", checked.alias("_south"), F.inline(sides))


def area_cells(areas: DataFrame) -> DataFrame:
    """Boxes with the cells they touch at their level, `_west` and `_east` of the part that touches them.

    `min_lon` above `max_lon` crosses the date line; `min_lat` above `max_lat` is refused. A box without a bound has no cells.
    """
    extent = F.greatest(F.col("max_lat") - F.col("_south"), F.col("_east") - F.col("_west"), F.lit(STEP ** LEAST_LEVEL))
    filed = _parts(areas).withColumn("_level", F.ceil(F.log(extent) / F.log(F.lit(STEP))).cast("int"))
    for axis, least, most in (("lat", "_south", "max_lat"), ("lon", "_west", "_east")):
        filed = filed.withColumn(f"_{axis}", F.explode(F.sequence(_cell(least), _cell(most))))
    return filed.drop("_south")


def locate(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Points (lat, lon) with each area they lie in; lower bounds belong to a box, upper bounds do not, except the pole.

    Meridians 180 and -180 are the same, and points and bounds may lie beyond them by up to a turn.
    """
    if not {"lat", "lon"} <= set(points.columns):
        raise ValueError("points need the columns lat and lon")
    filed = area_cells(areas)
    measured = filed.agg(F.sort_array(F.collect_set("_level")).alias("levels"), *measures(filed)).first()
    asking = points.withColumns({"_level": F.explode(F.array(*[F.lit(v) for v in measured["levels"] or [0]])), "_x": _eastward(F.col("lon"))})
    asking = asking.withColumns({"_lat": _cell("lat"), "_lon": _cell("_x")})
    keys = ["_level", "_lat", "_lon"]
    met = asking.join(F.broadcast(filed), keys) if within_bounds(measured) else salted_join(asking, filed, keys)
    below = (F.col("lat") < F.col("max_lat")) | ((F.col("max_lat") >= 90) & (F.col("lat") == 90))
    inside = (F.col("lat") >= F.col("min_lat")) & below & (F.col("_x") >= F.col("_west")) & (F.col("_x") < F.col("_east"))
    return met.where(inside).drop("_level", "_lat", "_lon", "_x", "_west", "_east")
