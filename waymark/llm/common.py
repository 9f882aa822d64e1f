"""What the corpus operators share: reading columns by name, running Python over slices of a task's rows, saved tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.session import saved

# Texts are handed to Python code in slices of about so many bytes (one text may be longer) and at most so many rows.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 2048

Work = Callable[..., list[Any]]

__all__ = ["WordNumbers", "Work", "ascii_words", "held_out", "map_slices", "pick", "saved", "table"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(df: DataFrame, keep: bool = False, **columns: str) -> DataFrame:
    """Only the named columns, under the names of the arguments; all others, clashing or not, are left out.

    With `keep` the whole row is a last column `_doc`, whose column names cannot clash.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc")] if keep else []
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()], *row)


def _slices(batch: pa.RecordBatch, column: pa.Array, slice_bytes: int, slice_rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batch by the bytes of one column."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        sizes += np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1])
    elif pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        sizes += np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1])
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + slice_bytes, side="right"))
        stop = min(max(stop, start + 1), start + slice_rows, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def _values(column: pa.Array) -> list[Any]:
    """Python values; strings as UTF-8 bytes."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def map_slices(
    df: DataFrame, begin: Callable[[], Work], schema: str, widest: int = 1, end: bool = False,
    slice_bytes: int = SLICE_BYTES, slice_rows: int = SLICE_ROWS, keep: str | None = None,
) -> DataFrame:
    """Runs Python over slices of the rows, in Arrow batches.

    `begin()` is called once per task and gives a function from the columns' values (lists; strings as UTF-8 bytes)
    to the columns of `schema`. With `end` it is called once more without arguments after the last row. `widest` is
    the column whose bytes bound a slice. With `keep` the last column, `_doc`, is handed on row by row, and its field of
    that name is read as column 1 in place of a `text` column, so that texts are sent once.
    """
    if keep is not None:
        df = df.select(*[c for c in df.columns if c != "text"])
    kept = df.schema.fields[-1:] if keep is not None else []
    inside = [f.name for f in kept[0].dataType.fields].index(keep) if kept else 0
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = begin()

        def made(columns: list[Any], rest: list[pa.Array]) -> pa.RecordBatch:
            arrays = [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(columns, arrow)]
            fields = [*arrow, *[pa.field(f.name, c.type) for f, c in zip(kept, rest)]]
            return pa.RecordBatch.from_arrays([*arrays, *rest], schema=pa.schema(fields))

        def read(batch: pa.RecordBatch) -> list[pa.Array]:
            columns = batch.columns[:len(batch.columns) - len(kept)]
            return [*columns[:1], batch.columns[-1].field(inside), *columns[1:]] if kept else columns

        for batch in batches:
            for part in _slices(batch, read(batch)[widest], slice_bytes, slice_rows) if batch.num_rows else ():
                yield made(work(*[_values(c) for c in read(part)]), part.columns[len(part.columns) - len(kept):])
            # What the last batch took is free for other workers.
            pa.default_memory_pool().release_unused()
        if end:
            yield made(work(), [])

    return df.mapInArrow(run, T.StructType([*T.StructType.fromDDL(schema).fields, *kept]))


class WordNumbers(dict):
    """A number for each word in the order in which words first came; `new` has those since it was last emptied."""

    def __init__(self) -> None:
        self.new: list[Any] = []

    def __missing__(self, word: Any) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def ascii_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased: what bytes.lower and bytes.split do; none for a missing text."""
    return text.lower().split() if text else []


def held_out(doc_id: Any, folds: int) -> Any:
    """Whether crc32 of the id as text is 0 modulo `folds`; a missing id counts as text without characters."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0
