"""Small comparisons used by several tests."""

from __future__ import annotations

import contextlib
import io
from collections import Counter

from pyspark.sql import DataFrame


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9)
    if isinstance(value, dict):
        return tuple(sorted(value.items()))
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def bag(df: DataFrame, *columns: str) -> Counter:
    names = list(columns) or sorted(df.columns)
    return Counter(tuple(plain(row[c]) for c in names) for row in df.collect())


def plan(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
