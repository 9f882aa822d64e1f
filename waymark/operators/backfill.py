"""Samples filled from date windows, newest first, until they are large enough."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.dedup import COUNT, dedup_count, present_keys
from waymark.operators.filters import TIMESTAMP, as_datetime, instant
from waymark.operators.joins import group_join
from waymark.operators.ranking import check_size, first_n, random_sample
from waymark.session import saved

# The first window ends this many days back, and this many edges are spread evenly.
FIRST_DAY = 15
EDGES = 15


def window_edges(now: str | dt.datetime, ago: int | str) -> list[dt.datetime]:
    """Window edges from the newest to the oldest; window i lies between edges i and i + 1."""
    days = int(ago)
    if days <= FIRST_DAY:
        raise ValueError(f"ago must be above {FIRST_DAY} days, not {days}")
    step = (days - FIRST_DAY) / (EDGES - 1)
    end = as_datetime(now)
    return [end - dt.timedelta(days=FIRST_DAY + i * step) for i in range(EDGES)]


def window_number(edges: list[dt.datetime], column: str = TIMESTAMP) -> Column:
    """Number of the window a time lies in: windows start at their older edge and end before the newer."""
    passed = sum((F.col(column) < instant(edge)).cast("int") for edge in edges)
    return passed - 1


# Above so many sizes of countries and windows all windows are made in one pass, and their sizes stay a table.
MOST_SIZES = 1_000_000


def _between(edges: list[dt.datetime], first: int, past: int, column: str, day: str | None) -> Column:
    """Rows of the windows from `first` on and before `past`; on the column of days too, so that folders by day are pruned."""
    inside = (F.col(column) >= instant(edges[past])) & (F.col(column) < instant(edges[first]))
    if day is None:
        return inside
    return inside & (F.col(day) >= F.lit(edges[past].date())) & (F.col(day) <= F.lit(edges[first].date()))


def _newest_windows(
    logs: DataFrame, edges: list[dt.datetime], sample: int, countries: int, column: str, day: str | None, deduplicate: bool,
) -> tuple[DataFrame, DataFrame]:
    """The rows of as many windows as the countries need, and the country and window of those taken.

    One window is read first, then twice as many at a time, each time without the countries that have enough. When all `countries` have,
    older windows are not read.
    """
    spark, by = logs.sparkSession, ["country", "window_id"]
    kinds = T.StructType([logs.schema["country"], T.StructField("window_id", T.IntegerType())])
    full = T.StructType([logs.schema["country"]])
    rows: list[DataFrame] = []
    held: dict[str, int] = {}
    taken: list[tuple[str, int]] = []
    first, step = 0, 1
    while first < EDGES - 1:
        past = min(first + step, EDGES - 1)
        numbered = logs.where(_between(edges, first, past, column, day)).withColumn("window_id", window_number(edges, column))
        enough = [(country,) for country, n in held.items() if n >= sample]
        if enough:
            numbered = numbered.join(F.broadcast(spark.createDataFrame(enough, full)), "country", "left_anti")
        part = saved(dedup_count(numbered, by), "windows") if deduplicate else numbered
        for size in part.groupBy(*by).count().orderBy("window_id").collect():
            country = size["country"]
            if held.get(country, 0) < sample:
                taken.append((country, size["window_id"]))
                held[country] = held.get(country, 0) + min(size["count"], sample)
        rows.append(part)
        if sum(n >= sample for n in held.values()) >= countries:
            break
        first, step = past, 2 * step
    return reduce(DataFrame.unionByName, rows), spark.createDataFrame(taken, kinds)


def adaptive_backfill(
    logs: DataFrame, now: str | dt.datetime, sample: int, ago: int | str = 365, countries: int | None = None,
    column: str = TIMESTAMP, deduplicate: bool = True, id_columns: Sequence[str] | None = None, seed: int = 0, day: str | None = None,
) -> DataFrame:
    """Rows of the newest windows of each country, taken until there are `sample` rows.

    Expects `country`. Each window is cut to its `sample` most repeated requests, or without `deduplicate` to `sample`
    random rows, which `id_columns` tell apart; a window is taken whole while the windows before it hold fewer than
    `sample` rows. Rows younger than the first edge are out. `countries` bounds the number of countries; with it windows are read newest
    first, and none once so many countries have enough. `day` names a column with the date of `column` by which the log is
    partitioned: then old folders are not even listed.
    """
    check_size(sample)
    edges = window_edges(now, ago)
    by = ["country", "window_id"]
    groups = countries and countries * (EDGES - 1)
    if sample and groups and groups <= MOST_SIZES:
        rows, taken = _newest_windows(logs, edges, sample, countries, column, day, deduplicate)
        chosen = rows.join(F.broadcast(taken), by, "left_semi")
    else:
        numbered = logs.where(_between(edges, 0, EDGES - 1, column, day)).withColumn("window_id", window_number(edges, column))
        # Deduplicated once for the sizes and the rows.
        rows = saved(dedup_count(numbered, by), "windows") if deduplicate else numbered
        # At most EDGES - 1 rows per country.
        sizes = rows.groupBy(*by).agg(F.least(F.count(F.lit(1)), F.lit(sample)).alias("_size"))
        newer = Window.partitionBy("country").orderBy("window_id").rowsBetween(Window.unboundedPreceding, -1)
        taken = (
            sizes.withColumn("_newer", F.coalesce(F.sum("_size").over(newer), F.lit(0)))
            .where(F.col("_newer") < sample)
            .select(*by)
        )
        chosen = group_join(rows, taken, by, groups, "left_semi")
    if deduplicate:
        return first_n(chosen, sample, by, count=COUNT, tie_columns=present_keys(logs), groups=groups)
    return random_sample(chosen, sample, seed, by, id_columns, groups)
