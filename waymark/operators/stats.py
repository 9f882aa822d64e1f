"""Bootstrap replicates and intervals, and component coverage.

Replicates weigh rows by independent Poisson(1) numbers instead of drawing n of n rows, and are scaled to n rows.
Rows are first summed up in cells by a hash of their id, and the weights are drawn per cell: one pass over the
rows with a partial aggregation, and a cost of cells x times after it, whatever the number of rows. A mean is a
ratio of two weighted sums; a sum or a count is n times the weighted mean per row. So all of them spread as in
draws of n of n rows, up to a relative 1 / sqrt(2 m) with m cells, well below the noise of a thousand replicates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.schemas import FLAG_COLUMNS

CELLS = 1 << 14
# Tasks the weights are drawn in; the cells alone would be too few bytes for more than one.
DRAW_TASKS = 64
# One md5 gives four numbers of eight hex digits.
PER_HASH = 4
# What is summed up per cell: numerators, denominators, rows.
SIDES = ("_above", "_below", "_rows")


def poisson_limits(last: int = 12) -> list[str]:
    """Cumulative Poisson(1) probabilities on the scale of eight hex digits, as hex text: text of equal
    length compares like the number it stands for."""
    limits, probability, total = [], math.exp(-1), 0.0
    for k in range(last):
        total += probability
        limits.append(f"{min(math.floor(total * 2 ** 32), 2 ** 32 - 1):08x}")
        probability /= k + 1
    return limits


def poisson_weight(draw: Column) -> Column:
    """Poisson(1) number for a uniform draw of eight hex digits."""
    limits = poisson_limits()
    weight = F.when(draw < limits[0], 0)
    for k, limit in enumerate(limits[1:], start=1):
        weight = weight.when(draw < limit, k)
    return weight.otherwise(len(limits))


def cell_of(id_column: str, cells: int = CELLS) -> Column:
    """Cell of a row, by hash of its id."""
    return F.conv(F.substring(F.md5(F.col(id_column).cast("string")), 1, 8), 16, 10).cast("bigint") % cells


def check_bootstrap(times: int, conf: float = 0.9) -> None:
    if times < 1:
        raise ValueError(f"times must be at least 1, not {times}")
    if not 0 < conf < 1:
        raise ValueError(f"conf must lie between 0 and 1, not {conf}")


def bootstrap_replicates(
    df: DataFrame, id_column: str, value: str, statistic: str = "mean", times: int = 1000, seed: int = 0,
    denominator: str | None = None, cells: int = CELLS,
) -> DataFrame:
    """(replicate, estimate) of a sum, a count, a mean or the ratio of `value` to `denominator`.

    NULL values count for nothing, but their rows are drawn like others. `id_column` must be unique.
    """
    check_bootstrap(times)
    if statistic not in ("sum", "count", "mean", "ratio") or (statistic == "ratio") != (denominator is not None):
        raise ValueError("statistic must be 'sum', 'count', 'mean', or 'ratio' with a denominator")
    below = F.col(denominator) if denominator else F.col(value).isNotNull().cast("double")
    sums = df.groupBy(cell_of(id_column, cells).alias("_cell")).agg(
        F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("_above"),
        F.coalesce(F.sum(below.cast("double")), F.lit(0.0)).alias("_below"),
        F.count(F.lit(1)).cast("double").alias("_rows"),
    )
    last_block = (times - 1) // PER_HASH
    drawn = sums.repartition(DRAW_TASKS, "_cell").select(
        "_cell", *SIDES, F.explode(F.sequence(F.lit(0), F.lit(last_block))).alias("_block")
    ).withColumn("_draws", F.md5(F.concat_ws("-", F.col("_cell").cast("string"), F.col("_block").cast("string"), F.lit(str(seed)))))
    # The draws are columns of their own, so that each is cut out once and not for every limit it is compared to.
    cut = drawn.withColumns({f"_d{i}": F.substring("_draws", 1 + 8 * i, 8) for i in range(PER_HASH)})
    weights = {f"_w{i}": poisson_weight(F.col(f"_d{i}")) for i in range(PER_HASH)}
    summed = cut.withColumns(weights).groupBy("_block").agg(*[
        F.sum(F.col(f"_w{i}") * F.col(side)).alias(f"{side}{i}") for i in range(PER_HASH) for side in SIDES
    ], F.sum("_rows").alias("_all"))
    above, below, drawn_rows, all_rows = F.col("_r._above"), F.col("_r._below"), F.col("_r._rows"), F.col("_r._all")
    estimate = {
        "sum": F.try_divide(all_rows * above, drawn_rows), "count": F.try_divide(all_rows * below, drawn_rows),
        "mean": F.try_divide(above, below), "ratio": F.try_divide(above, below),
    }[statistic]
    each = F.explode(F.array(*[
        F.struct(
            (F.col("_block") * PER_HASH + i).alias("replicate"), F.col("_all"),
            *[F.col(f"{side}{i}").alias(side) for side in SIDES],
        ) for i in range(PER_HASH)
    ])).alias("_r")
    return (
        summed.select(each).where(F.col("_r.replicate") < times)
        .select(F.col("_r.replicate").cast("int").alias("replicate"), estimate.alias("estimate"))
    )


def percentile_interval(replicates: DataFrame, conf: float = 0.9) -> DataFrame:
    """(lower_bound, upper_bound) of the replicates, linearly interpolated. There are `times` replicates."""
    check_bootstrap(1, conf)
    low = (1 - conf) / 2
    bounds = F.percentile("estimate", F.array(F.lit(low), F.lit(low + conf)))
    return replicates.agg(bounds.alias("_b")).select(
        F.col("_b")[0].alias("lower_bound"), F.col("_b")[1].alias("upper_bound")
    )


def bootstrap_ci(
    df: DataFrame, id_column: str, value: str, statistic: str = "mean", conf: float = 0.9, times: int = 1000,
    seed: int = 0, denominator: str | None = None, cells: int = CELLS,
) -> DataFrame:
    """Percentile interval of the bootstrap replicates."""
    return percentile_interval(
        bootstrap_replicates(df, id_column, value, statistic, times, seed, denominator, cells), conf
    )


def component_coverage(flags: DataFrame, by: Sequence[str] = ("country",)) -> DataFrame:
    """Rows and rows with each component, per country."""
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(f).cast("int")).alias(f) for f in FLAG_COLUMNS.values()]
    )
