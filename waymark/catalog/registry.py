"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from waymark.fixtures import with_views

Job = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    job: Job
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, views: list[str], body: str | None = None, steps: dict[str, str] | None = None) -> Callable[[Job], Job]:
    """Registers a job; `body` is its SQL over `views` and `steps`."""

    def register(job: Job) -> Job:
        ENTRIES[name] = Entry(job, None if body is None else with_views(views, body, steps))
        return job

    return register
