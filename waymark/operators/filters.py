"""Row predicates over the log, result and indicator tables.

Log texts are never null in the log store, so exclusions keep missing values. Names compared without
case are lowered on both sides; keep a lowered or partitioned copy of such a column where the scan has
to prune on it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.schemas import FULL_ADDRESS, NEARBY_ENDPOINT

TIMESTAMP = "client_received_start_timestamp"
# Columns that a log written by day has besides its own: the date, by which it is partitioned, and the lowered country name.
DAY, COUNTRY_NAME = "log_day", "country_name_lower"

Names = Sequence[str] | str | None


def as_datetime(now: str | dt.datetime) -> dt.datetime:
    return now if isinstance(now, dt.datetime) else dt.datetime.fromisoformat(now)


def instant(moment: dt.datetime) -> Column:
    """A point in time without a zone, so that the session zone does not move it."""
    return F.lit(moment.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def as_names(values: Names, argument: str, text_allowed: bool = True) -> list[str] | None:
    """Checked list of names; a lone text stands for one name where that is allowed."""
    if values is None:
        return None
    if isinstance(values, str):
        if not text_allowed:
            raise ValueError(f"{argument} must be a list, a tuple or None")
        return [values]
    if not isinstance(values, (list, tuple)) or not all(isinstance(v, str) for v in values):
        raise ValueError(f"{argument} must hold texts in a list or a tuple, or be None")
    return list(values)


def everything() -> Column:
    return F.lit(True)


def looked_back(now: str | dt.datetime, days: int | str | None, column: str = TIMESTAMP) -> Column:
    """Strictly younger than `days` before `now`; None keeps all."""
    if days is None:
        return everything()
    return F.col(column) > instant(as_datetime(now) - dt.timedelta(days=int(days)))


def in_date_range(now: str | dt.datetime, furthest: float, recent: float, column: str = TIMESTAMP) -> Column:
    """From `furthest` days before `now`, included, to `recent` days before it, not included, so that
    ranges that follow each other share no row."""
    if furthest < recent:
        raise ValueError(f"furthest ({furthest}) must not be below recent ({recent})")
    end = as_datetime(now)
    start, stop = end - dt.timedelta(days=furthest), end - dt.timedelta(days=recent)
    return (F.col(column) >= instant(start)) & (F.col(column) < instant(stop))


def on_days(now: str | dt.datetime, furthest: float, recent: float = 0, column: str = TIMESTAMP, day: str = DAY) -> Column:
    """`in_date_range` over a log written by day: the same rows, from the folders of these days alone."""
    end = as_datetime(now)
    first, last = (end - dt.timedelta(days=d) for d in (furthest, recent))
    return F.col(day).between(F.lit(first.date()), F.lit(last.date())) & in_date_range(now, furthest, recent, column)


def country_named(names: Names) -> Column:
    """One of the country names in any case, over a log written by day: compared with the column whose row groups can be left out."""
    given = as_names(names, "names")
    return everything() if given is None else F.col(COUNTRY_NAME).isin([n.lower() for n in given])


def full_addresses(only: bool = True) -> Column:
    return F.col("who_searched") == FULL_ADDRESS if only else everything()


def named(column: str, values: Names, argument: str | None = None) -> Column:
    """Equal to one of the names without regard to case; None keeps all."""
    names = as_names(values, argument or column, text_allowed=False)
    return everything() if names is None else F.lower(F.col(column)).isin([n.lower() for n in names])


def not_named(column: str, values: Names, argument: str | None = None) -> Column:
    """Equal to none of the names without regard to case; missing values stay."""
    names = as_names(values, argument or column)
    if names is None:
        return everything()
    return ~F.coalesce(F.lower(F.col(column)).isin([n.lower() for n in names]), F.lit(False))


def with_populated_fields(values: Names) -> Column:
    """populated_fields is one of the texts, case included."""
    names = as_names(values, "populated_fields", text_allowed=False)
    return everything() if names is None else F.col("populated_fields").isin(names)


def readable(column: str = "searched_query") -> Column:
    """Without the replacement character of broken text; missing text stays."""
    return ~F.coalesce(F.col(column).contains("�"), F.lit(False))


def not_nearby(column: str = "method_name") -> Column:
    return ~F.col(column).eqNullSafe(NEARBY_ENDPOINT)


def confident(threshold: float | None, column: str = "confidence") -> Column:
    """At or above the threshold; None keeps all."""
    return everything() if threshold is None else F.col(column) >= threshold


def unanswered(column: str = "apiResults") -> Column:
    return F.col(column).isNull()
