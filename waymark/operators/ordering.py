"""Row numbers and running sums over a whole table, without a window in one task.

The table is range-partitioned once and checkpointed, which fixes the partitions; each partition then
only needs the total of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.joins import content_hash
from waymark.session import fix_partitions

# monotonically_increasing_id keeps the position within the partition in its lower bits.
POSITION_MASK = (1 << 33) - 1


def row_index(df: DataFrame, order: Sequence[str | Column], to: str = "id") -> DataFrame:
    """Adds consecutive numbers from 0 in the stated order.

    Rows equal in `order` follow each other by a hash of their content, and exact copies by their position in
    the input, so that many equal rows still spread over partitions. Only copies can change places when a
    lost task is run again. The offsets are one row per partition.
    """
    placed = df.withColumns({"_content": content_hash(df), "_tie": F.monotonically_increasing_id()})
    sort = [*order, "_content", "_tie"]
    fixed = fix_partitions(placed.repartitionByRange(*sort).sortWithinPartitions(*sort))
    marked = fixed.withColumns({
        "_part": F.spark_partition_id(),
        "_position": F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK)),
    })
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(to, F.col("_offset") + F.col("_position"))
        .drop("_part", "_position", "_offset", "_content", "_tie")
    )


def running_sum(
    df: DataFrame, index: str, values: Sequence[str], by: Sequence[str] = (), ties: Sequence[str] = (), merge: bool = False,
) -> DataFrame:
    """Cumulative sums of `values` along `index`, for each key in `by` or over the whole table.

    One row for each row, with the key, index and tie columns; rows of one index value follow each other by `ties`,
    then by a hash of their content. With `merge` rows of one index value are summed up first and give one row. A key
    that holds most rows spreads over range partitions like any other.
    """
    columns = [*by, index] if merge else [*by, index, *ties]
    if merge:
        points = df.groupBy(*columns).agg(*[F.sum(v).alias(v) for v in values])
        order = [index]
    else:
        points = df.select(*dict.fromkeys([*columns, *values]), content_hash(df).alias("_content"))
        order = [index, *ties, "_content"]
    fixed = fix_partitions(points.repartitionByRange(*by, *order))
    marked = fixed.withColumn("_part", F.spark_partition_id())
    # As a struct, missing keys are equal to each other and join like any other.
    keys = ["_group"] if by else []
    marked = marked.withColumn("_group", F.struct(*by)) if by else marked
    # At most one row per partition and key start.
    totals = marked.groupBy(*keys, "_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_part", *[F.sum(f"_sum_{v}").over(earlier).alias(f"_before_{v}") for v in values]
    )
    along = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = marked.select(*keys, *columns, "_part", *[F.sum(v).over(along).alias(f"_inside_{v}") for v in values])
    # `inside` is already partitioned by the join keys; without keys there is one offset per partition.
    joined = inside.join(offsets if keys else F.broadcast(offsets), [*keys, "_part"])
    # Missing values add nothing; a sum is missing as long as there was no value.
    total = {v: (F.col(f"_before_{v}"), F.col(f"_inside_{v}")) for v in values}
    return joined.select(
        *columns, *[F.coalesce(before + inner, before, inner).alias(f"running_{v}") for v, (before, inner) in total.items()]
    )
