"""Writers of country samples, parsed tables and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waymark.functions.geo import point_text
from waymark.operators.filters import COUNTRY_NAME, DAY, TIMESTAMP
from waymark.operators.joins import content_hash, measures
from waymark.schemas import SAMPLE_COLUMNS
from waymark.session import PARTITION_BYTES, saved

CSV_OPTIONS = {"quote": '"', "escape": '"', "header": "true"}
ROWS_PER_FILE = 1_000_000


def _write(df: DataFrame, path: str, file_format: str, sep: str, by: str | None, mode: str) -> None:
    if file_format not in ("csv", "parquet"):
        raise ValueError(f"file_format must be 'csv' or 'parquet', not {file_format!r}")
    writer = df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
    if by is not None:
        writer = writer.partitionBy(by)
    if file_format == "csv":
        writer.options(sep=sep, **CSV_OPTIONS).csv(path)
    else:
        writer.parquet(path)


def by_country(df: DataFrame) -> DataFrame:
    """Rows brought together by country before a partitioned write, which sorts each task's rows by country.

    Adaptive execution goes by compressed bytes, and rows that are much alike shrink a hundredfold: a task could be given any number of
    them. So the rows are saved and measured, and tasks are ranges of country and row of at most about ROWS_PER_FILE rows and
    PARTITION_BYTES.
    """
    kept = saved(df, "by-country")
    measured = kept.agg(*measures(kept)).first()
    tasks = max(1, -(-measured["_n"] // ROWS_PER_FILE), -(-measured["_bytes"] // PARTITION_BYTES))
    # Equal rows too may be more than one task's share.
    return kept.repartitionByRange(tasks, "country", F.xxhash64(F.monotonically_increasing_id()))


def write_country_samples(
    df: DataFrame, path: str, file_format: str = "parquet", sep: str = ";",
    columns: Sequence[str] | None = tuple(SAMPLE_COLUMNS), mode: str = "overwrite", name: str | None = None,
) -> str:
    """One folder per country, under the sample's name where one is given; returns the folder above them."""
    chosen = df if columns is None else df.select(*columns)
    folder = path if name is None else f"{path}/{name}"
    _write(by_country(chosen), folder, file_format, sep, "country", mode)
    return folder


def write_log_by_day(logs: DataFrame, path: str, mode: str = "overwrite", column: str = TIMESTAMP, row_group_bytes: int = 32 << 20) -> None:
    """The log in one folder per day, with lowered country names in order within the files.

    Adds DAY, the partition, and COUNTRY_NAME, whose least and greatest value per row group let scans of few countries leave groups out. Tasks are
    ranges of day, country and content, so neither a day nor a country that holds most rows is one task. Rows without a time are in a
    partition of their own.
    """
    placed = logs.withColumns({DAY: F.to_date(column), COUNTRY_NAME: F.lower("countryName")})
    placed = placed.repartitionByRange(DAY, COUNTRY_NAME, content_hash(logs)).sortWithinPartitions(DAY, COUNTRY_NAME)
    placed.write.mode(mode).option("parquet.block.size", row_group_bytes).partitionBy(DAY).parquet(path)


def write_parsed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write(df, path, "parquet", "", None, mode)


def write_results(df: DataFrame, path: str | None, mode: str = "overwrite") -> None:
    """Results as CSV; nothing is written for an empty path."""
    if path:
        _write(df, path, "csv", ",", None, mode)


def write_country_results(results: DataFrame, countries: Sequence[str], path: str, mode: str = "overwrite") -> DataFrame:
    """Provider results as tab-separated files, one folder per country, and the status of each country.

    Coordinates become numbers, and one text. Which countries have rows is observed while they are written.
    """
    placed = results.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lon")})
    placed = placed.withColumn("coordinates", point_text(F.col("lat"), F.col("lon")))
    listed = placed.where(F.col("country").isin(list(countries)))
    seen = Observation()
    found = {f"c{i}": F.max((F.col("country") == c).cast("int")).alias(f"c{i}") for i, c in enumerate(countries)}
    _write(by_country(listed.observe(seen, *found.values())), path, "csv", "\t", "country", mode)
    rows = [(c, "Done" if seen.get[name] == 1 else "Incomplete") for name, c in zip(found, countries)]
    return results.sparkSession.createDataFrame(rows, "country string, status string")
