"""Nested point-of-interest results as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.schemas import RESULT_LIST, TEXT_MAP


def read_results(text: Column) -> Column:
    """Result list text as an array of maps; nested JSON stays text."""
    return F.from_json(text, RESULT_LIST)


def split_classification(text: Column) -> Column:
    """Category list of a classification text. The marks go one after another: a later one may only
    come to stand alone once an earlier one is gone."""
    for mark in ('{"', '"}', "(", ")", '"'):
        text = F.replace(text, F.lit(mark), F.lit(""))
    return F.split(text, ",")


def nested_map(text: Column) -> Column:
    return F.from_json(text, TEXT_MAP)


def first_of(text: Column, field: str) -> Column:
    """Field of the first map in a JSON list text, NULL where the list is missing or empty."""
    return F.get(F.from_json(text, RESULT_LIST), F.lit(0))[field]
