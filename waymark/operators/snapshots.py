"""Monthly snapshots of an indicator under compound growth."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The first and the last month, and the growth from one to the next.
FIRST_MONTH = dt.date(2022, 1, 1)
MONTHS = 17
GROWTH = 1.1


def growth_snapshots(
    df: DataFrame, value: str = "lifeExp", first: dt.date = FIRST_MONTH, months: int = MONTHS, growth: float = GROWTH,
) -> DataFrame:
    """One copy of every row per month, `value` grown once more each month, the first included."""
    number = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("_k")
    others = [c for c in df.columns if c != value]
    return df.select(*others, value, number).select(
        *others, (F.col(value) * F.pow(F.lit(growth), F.col("_k"))).alias(value),
        F.add_months(F.lit(first), F.col("_k") - 1).alias("date"),
    )


def on_dates(snapshots: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    return snapshots.where(F.col("date").isin(list(dates)))


def indicator_year(df: DataFrame, year: int = 2007) -> DataFrame:
    """Complete rows of one year."""
    return df.where(F.col("year") == year).na.drop()
