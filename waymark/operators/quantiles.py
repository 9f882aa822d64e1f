"""Bootstrap replicates of medians and other quantiles.

The quantile's neighbourhood is found first: counts in even slots between two values, narrowed until the ranks in which
any replicate can lie take up enough slots. Rows are then counted per hash cell and slot, everything below and above the
neighbourhood in one slot each. A replicate weighs the cells by Poisson(1) numbers, as `operators.stats` does, so its slot
counts are a product of two matrices, made for some slots in each task; what is summed up is cells x slots, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.stats import PER_HASH, cell_of, check_bootstrap, percentile_interval, poisson_limits

CELLS = 1 << 11
SLOTS = 1 << 12
# The neighbourhood reaches so many standard errors of the rank to either side, and takes up at least so many slots.
ERRORS = 8
LEAST_SLOTS = 32
MOST_PASSES = 6
DRAW_TASKS = 16


def draws(times: int, cells: int, seed: int) -> np.ndarray:
    """Poisson(1) weights, times x cells: those that `operators.stats` draws for the cells."""
    blocks = -(-times // PER_HASH)
    digests = b"".join(
        hashlib.md5(f"{cell}-{block}-{seed}".encode()).digest() for block in range(blocks) for cell in range(cells)
    )
    numbers = np.frombuffer(digests, ">u4").reshape(blocks, cells, PER_HASH).transpose(0, 2, 1).reshape(-1, cells)[:times]
    limits = np.array([int(limit, 16) for limit in poisson_limits()], np.uint32)
    return np.searchsorted(limits, numbers, side="right").astype(np.float64)


def slot_of(value: Column, low: float, high: float) -> Column:
    """Slot of a value between the bounds, -1 below and SLOTS above; without a distance all in one."""
    if not high > low:
        return F.when(value < low, -1).when(value > high, SLOTS).otherwise(0)
    inside = F.least(F.floor((value - low) / F.lit(high - low) * SLOTS), F.lit(SLOTS - 1))
    return F.when(value < low, -1).when(value > high, SLOTS).otherwise(inside).cast("int")


def neighbourhood(values: DataFrame, q: float) -> tuple[float, float, int, int] | None:
    """Two values and, of the slots between them, the first and last that a replicate's quantile may lie in; none without values.

    Every pass counts all rows by slot, so at most SLOTS + 2 numbers reach the driver.
    """
    n, low, high = values.agg(F.count(F.lit(1)), F.min("_value"), F.max("_value")).first()
    if not n:
        return None
    error = ERRORS * math.sqrt(q * (1 - q) * n) + 1
    for number in range(MOST_PASSES):
        slots = values.groupBy(slot_of(F.col("_value"), low, high).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        counts = np.zeros(SLOTS + 2, np.int64)
        for row in slots.collect():
            counts[row["slot"] + 1] = row["n"]
        past = np.cumsum(counts)[:-1]
        first = max(int(np.searchsorted(past, max(q * n - error, 0), side="right")) - 1, 0)
        last = min(int(np.searchsorted(past, min(q * n + error, n), side="left")) - 1, SLOTS - 1)
        width = (high - low) / SLOTS
        narrowed = low + first * width, low + (last + 1) * width
        if last - first + 1 >= LEAST_SLOTS or number == MOST_PASSES - 1 or not low <= narrowed[0] < narrowed[1] <= high or narrowed == (low, high):
            return low, high, first, max(first, last)
        low, high = narrowed
    raise AssertionError


def quantile_replicates(
    df: DataFrame, id_column: str, value: str, q: float = 0.5, times: int = 1000, seed: int = 0, cells: int = CELLS,
) -> DataFrame:
    """(replicate, estimate) of the quantile `q` of `value`, interpolated within a slot.

    NULL, NaN and infinite values are left out; without any other every estimate is NULL. `id_column` must be unique. A slot is at most
    a 32nd of sixteen standard errors wide, or as narrow as six passes and the numbers allow.
    """
    check_bootstrap(times)
    if not 0 < q < 1:
        raise ValueError(f"q must lie between 0 and 1, not {q}")
    number = F.col(value).cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < math.inf)
    values = df.where(finite).select(number.alias("_value"), cell_of(id_column, cells).alias("_cell"))
    spark = df.sparkSession
    found = neighbourhood(values, q)
    every = spark.range(times).select(F.col("id").cast("int").alias("replicate"))
    if found is None:
        return every.withColumn("estimate", F.lit(None).cast("double"))
    low, high, first, last = found
    # Slots outside the neighbourhood count together on either side.
    slot = F.greatest(F.least(slot_of(F.col("_value"), low, high), F.lit(last + 1)), F.lit(first - 1))
    counted = values.groupBy("_cell", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        own, place = np.unique(rows.column("slot").to_numpy(), return_inverse=True)
        sizes = np.zeros((cells, len(own)))
        sizes[rows.column("_cell").to_numpy(), place] = rows.column("n").to_numpy()
        weights = draws(times, cells, seed) @ sizes
        replicate, column = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays([
            pa.array(replicate, pa.int32()), pa.array(own[column], pa.int32()), pa.array(weights[replicate, column], pa.float64()),
        ], names=["replicate", "slot", "weight"])

    weighted = counted.repartition(DRAW_TASKS, "slot").mapInArrow(draw, "replicate int, slot int, weight double")
    # A replicate has at most as many rows as the neighbourhood has slots.
    along = Window.partitionBy("replicate").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    summed = weighted.withColumns({"_past": F.sum("weight").over(along), "_all": F.sum("weight").over(Window.partitionBy("replicate"))})
    width = (high - low) / SLOTS
    share = (F.lit(q) * F.col("_all") - (F.col("_past") - F.col("weight"))) / F.col("weight")
    inside = F.lit(low) + (F.col("slot") + share) * F.lit(width)
    estimate = F.when(F.col("slot") < first, F.lit(low + first * width)).when(F.col("slot") > last, F.lit(low + (last + 1) * width)).otherwise(inside)
    reached = summed.where(F.col("_past") >= F.lit(q) * F.col("_all")).groupBy("replicate").agg(F.min_by(estimate, "slot").alias("estimate"))
    return every.join(reached, "replicate", "left")


def quantile_ci(
    df: DataFrame, id_column: str, value: str, q: float = 0.5, conf: float = 0.9, times: int = 1000, seed: int = 0, cells: int = CELLS,
) -> DataFrame:
    """Percentile interval of the replicates."""
    check_bootstrap(times, conf)
    return percentile_interval(quantile_replicates(df, id_column, value, q, times, seed, cells), conf)
