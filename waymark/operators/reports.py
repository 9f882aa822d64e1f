"""Status counts of enrichment rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def api_status_report(df: DataFrame) -> DataFrame:
    """Rows by api_status (1 where there are results) and number of calls."""
    status = F.when(F.col("apiResults").isNull(), 0).otherwise(1)
    return df.groupBy(status.alias("api_status"), "apiCalls").count()


def null_result_count(df: DataFrame, column: str = "apiResults") -> DataFrame:
    """All rows and those without a result."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(F.when(F.col(column).isNull(), True)).alias("null_rows")
    )
