"""Readers of log, dimension and saved tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# An empty field is NULL and a quoted empty one is empty text; they are told apart only if the mark that
# stands for NULL while reading is not empty itself.
CSV_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "\u0001", "emptyValue": ""}


def scan_logs(
    spark: SparkSession, table: str | None = None, path: str | None = None, schema: T.StructType | str | None = None,
) -> DataFrame:
    """The log table by name, or the parquet files under `path`."""
    if (table is None) == (path is None):
        raise ValueError("name either a table or a path")
    if table is not None:
        return spark.table(table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def path_format(path: str) -> str | None:
    """The word after the last dot that one follows, None where there is none."""
    found = re.match(r".+\.(\w+)", path)
    return found.group(1) if found else None


def read_by_format(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ";", header: bool = True,
    file_format: str | None = None, line_breaks: bool = False,
) -> DataFrame:
    """CSV or parquet by the ending of the path, or as `file_format` says. Without a schema CSV columns are text.

    With `line_breaks` quoted values may hold line breaks, but then each CSV file is one task: write CSV in many files.
    """
    kind = file_format or path_format(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        return reader.options(sep=sep, header=header, multiLine=line_breaks, **CSV_OPTIONS).csv(path)
    if kind == "parquet":
        return reader.parquet(path)
    raise ValueError(f"the path must end in .csv or .parquet: {path}")
