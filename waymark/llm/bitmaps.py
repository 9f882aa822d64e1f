"""A bitmap of hashes of fixed size, gathered by Spark: leaves out most rows that a later join would not match.

With many more hashes than bits it lets everything pass, so nothing may depend on it but speed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """One bit per value of the low BITS bits; at most 2^(BITS - 6) words reach the driver."""
    low = F.col(column).bitwiseAND((1 << BITS) - 1)
    words = hashes.where(F.col(column).isNotNull()).groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash (int64) may be in the bitmap."""
    low = hashes & ((1 << BITS) - 1)
    return bits[low >> 6] >> (low & 63) & 1 == 1


def parted(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """`rows` whose value in `column` is surely not among the keys, and the others; a later join needs only these."""
    content = rows.sparkSession.sparkContext.broadcast(bitmap(keys.select(F.xxhash64(column).alias("_hash")), "_hash"))

    def part(among: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
                chosen = batch.filter(pa.array(marked(content.value, hashes) == among))
                yield pa.RecordBatch.from_arrays(chosen.columns[:-1], names=batch.schema.names[:-1])

        return rows.withColumn("_hash", F.xxhash64(column)).mapInArrow(run, rows.schema)

    return part(False), part(True)
