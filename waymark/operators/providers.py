"""The same points answered by several providers, and level x provider tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.areas import locate
from waymark.operators.joins import salted_join
from waymark.schemas import AREA_PROVIDERS, PROVIDERS
from waymark.session import saved


def level_columns(levels: Sequence[str], providers: Sequence[str], suffix: str | None = None) -> dict[str, tuple[str, str]]:
    """Column name -> (level, provider), provider by provider."""
    tail = f"_{suffix}" if suffix is not None else ""
    return {f"{level}_{provider}{tail}": (level, provider) for provider in providers for level in levels}


def provider_unpivot(
    df: DataFrame, id_column: str, levels: Sequence[str], providers: Sequence[str], suffix: str | None = None,
) -> DataFrame:
    """(id, level, provider, value) rows of a table with one column per level and provider."""
    cells = F.array(*[
        F.struct(F.lit(level).alias("level"), F.lit(provider).alias("provider"), F.col(name).cast("string").alias("value"))
        for name, (level, provider) in level_columns(levels, providers, suffix).items()
    ])
    return df.select(id_column, F.inline(cells))


def provider_pivot(
    df: DataFrame, id_column: str, levels: Sequence[str], providers: Sequence[str], suffix: str | None = None,
) -> DataFrame:
    """The wide table back from (id, level, provider, value) rows, one aggregation."""
    return df.groupBy(id_column).agg(*[
        F.max(F.when((F.col("level") == level) & (F.col("provider") == provider), F.col("value"))).alias(name)
        for name, (level, provider) in level_columns(levels, providers, suffix).items()
    ])


def check_providers(providers: Sequence[str]) -> None:
    unknown = [p for p in providers if p not in PROVIDERS]
    if unknown or not providers:
        raise ValueError(f"providers must be some of {PROVIDERS}, not {list(providers)}")


def provider_fanout(points: DataFrame, providers: Sequence[str] = tuple(PROVIDERS)) -> DataFrame:
    """Every row once per provider."""
    check_providers(providers)
    return points.withColumn("provider_id", F.explode(F.array(*[F.lit(p) for p in providers])))


PLACE = ["lat", "lon"]


def _request_answers(responses: DataFrame, providers: Sequence[str]) -> DataFrame:
    """One row per point with a column per provider; a point has a handful of answers."""
    return responses.where(F.col("provider_id").isin(list(providers))).groupBy(*PLACE).agg(*[
        F.max(F.when(F.col("provider_id") == p, F.col("results"))).alias(f"_{p}") for p in providers
    ])


def _area_answers(places: DataFrame, areas: DataFrame, providers: Sequence[str]) -> DataFrame:
    """One row per point and country, with all areas that a provider has there as a JSON list, by area id.

    An area answers for points of its own country only; levels that lie in each other are all in the list.
    """
    own = areas.where(F.col("provider_id").isin(list(providers))).withColumnRenamed("country", "_area_country")
    found = locate(places, own).where(F.col("_area_country") == F.col("_country"))
    listed = [
        F.array_sort(F.collect_list(F.when(F.col("provider_id") == p, F.struct("area_id", "area_name")))).alias(f"_{p}") for p in providers
    ]
    answers = found.groupBy(*PLACE, "_country").agg(*listed)
    return answers.select(*PLACE, "_country", *[F.when(F.size(f"_{p}") > 0, F.to_json(f"_{p}")).alias(f"_{p}") for p in providers])


def _answered(
    points: DataFrame, providers: Sequence[str], responses: DataFrame | None, areas: DataFrame | None, id_column: str,
) -> DataFrame:
    """Every row once per provider, with the provider's answer.

    Points are counted once, and that table is saved: all answers are put side by side for each distinct point from it, so the
    rows are shuffled once and multiplied by the providers only after that; a point that many rows share is
    looked up once.
    """
    by_area = [p for p in providers if p in AREA_PROVIDERS] if areas is not None else []
    by_request = [p for p in providers if p not in by_area]
    keys = [*PLACE, "_country"] if by_area else PLACE
    placed = points.withColumn("_country", F.coalesce(F.col("country").cast("string"), F.lit(""))) if by_area else points
    counts = saved(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "places")
    answers = counts.select(*keys)
    if by_request:
        answers = answers.join(_request_answers(responses, by_request), PLACE, "left")
    if by_area:
        answers = answers.join(_area_answers(counts.select(*keys), areas, by_area), keys, "left")
    joined = salted_join(placed, answers, keys, "left", counts, [id_column])
    each = F.array(*[F.struct(F.lit(p).alias("provider_id"), F.col(f"_{p}").alias("results")) for p in providers])
    return joined.select(*points.columns, F.inline(each))


def answered_by_request(points: DataFrame, responses: DataFrame, providers: Sequence[str], id_column: str = "id") -> DataFrame:
    """Rows per provider with the provider's answer for their point, NULL where it has none.

    `responses` holds (provider_id, lat, lon, results), at most one per provider and point.
    """
    check_providers(providers)
    return _answered(points, providers, responses, None, id_column)


def compare_providers(
    points: DataFrame, responses: DataFrame, areas: DataFrame, providers: Sequence[str] = tuple(PROVIDERS),
    id_column: str = "id",
) -> DataFrame:
    """All rows answered by all providers, tagged with provider_id.

    Map providers answer from `areas` (provider_id, country, area_id, area_name and the bounds), each from its own areas
    of the point's country.
    """
    check_providers(providers)
    if not {*PLACE, "country"} <= set(points.columns):
        raise ValueError("points need the columns lat, lon and country")
    placed = points.withColumns({c: F.col(c).try_cast("double") for c in PLACE})
    return _answered(placed, providers, responses, areas, id_column)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a part lacks are NULL."""
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united
