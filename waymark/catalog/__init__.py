"""All registered queries."""

from waymark.catalog import address, geocode, logs, poi, providers, stats, streams  # noqa: F401
from waymark.catalog.registry import ENTRIES

__all__ = ["ENTRIES"]
