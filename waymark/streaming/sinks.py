"""Append streams that end by themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, file_format: str = "parquet", by: Sequence[str] = (),
) -> None:
    """Writes what is available now and waits for the end; a second run goes on after the first."""
    writer = stream.writeStream.format(file_format).outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet", files_per_batch: int | None = None,
) -> DataFrame:
    """A folder as a stream; `files_per_batch` bounds how much one micro-batch takes."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_saved(spark: SparkSession, path: str, schema: T.StructType | None = None, file_format: str = "parquet") -> DataFrame:
    """The batch view of a stream's output."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(file_format).load(path)
