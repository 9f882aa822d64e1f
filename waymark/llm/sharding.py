"""Sharding by longest-processing-time scheduling: equal texts stay together, the largest group goes to the least loaded shard.

The heap runs in two places, so that neither the driver nor a task sees all groups. Groups above 1 / (shards x HEAD)
of all bytes, at most shards x HEAD of them, are scheduled in one heap on the driver. The others are dealt into blocks
by a hash, and each block runs the same heap from the room that the large groups have left, scaled to the block's
bytes; the blocks' errors are about one small text each. Rows of groups that are large in bytes or in rows get their
shard from a broadcast table of bounded size, so that no task has all rows of such a group.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import pick, saved

HEAD = 1024
BLOCK_GROUPS = 1000
ROWS_PER_SLOT_TASK = 100_000
KEY = ["_hash", "_crc", "_size"]


def least_loaded(sizes: list[int], loads: list[float]) -> list[int]:
    """The shard of each size; `sizes` descend. `loads` are what the shards hold before, ties go to the lower shard."""
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    chosen = []
    for size in sizes:
        load, shard = heap[0]
        chosen.append(shard)
        heapq.heapreplace(heap, (load + size, shard))
    return chosen


def room(loads: list[int], rest: int) -> list[float]:
    """How the least loaded shards share `rest` so that all that get some end equal."""
    ordered = sorted(loads)
    filled, level = 0, 0.0
    for n, load in enumerate(ordered, start=1):
        filled += load
        level = (filled + rest) / n
        if n == len(ordered) or level <= ordered[n]:
            break
    return [max(0.0, level - load) for load in loads]


def shard_documents(docs: DataFrame, shards: int = 16, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Places all rows in shards of nearly equal bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A row's size is the UTF-8 bytes of its text plus 1; a missing text has size 1 and crc 0, and all missing texts are
    one group, apart from the empty ones. Rows repeated or without id are placed like any other. Slots count from 0
    in each shard without gaps. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id, text=text).select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text", F.col("text").isNull()).alias("_hash"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("_crc"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("_size"),
    )
    rows = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    counted = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_rows"))
    groups = saved(counted.withColumn("_bytes", F.col("_rows") * F.col("_size")), "shard-groups")
    nothing = F.lit(0)
    count, total, members = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("_bytes"), nothing), F.coalesce(F.sum("_rows"), nothing)).first()
    least, least_rows = total / (shards * HEAD), members / (shards * HEAD)

    # At most shards x HEAD groups reach `least`.
    large = groups.where(F.col("_bytes") >= least).orderBy(F.desc("_bytes"), *KEY).toPandas()
    large["shard"] = least_loaded(large["_bytes"].tolist(), [0] * shards)
    loads = [int(large.loc[large["shard"] == s, "_bytes"].sum()) for s in range(shards)]
    rest = total - sum(loads)
    left = room(loads, rest)

    def block(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_bytes", *KEY], ascending=[False, True, True, True])
        scale = int(group["_bytes"].sum()) / rest
        group["shard"] = least_loaded(group["_bytes"].tolist(), [-share * scale for share in left])
        return group[[*KEY, "_rows", "shard"]]

    schema = "_hash long, _crc long, _size long, _rows long, shard int"
    blocks = max(1, math.ceil(count / BLOCK_GROUPS))
    small = groups.where(F.col("_bytes") < least).groupBy(F.pmod("_hash", F.lit(blocks)).alias("_block")).applyInPandas(block, schema)
    head = spark.createDataFrame(list(large[[*KEY, "_rows", "shard"]].itertuples(index=False, name=None)), schema)
    chosen = saved(small.unionByName(head), "shard-chosen")
    # At most shards x HEAD groups by bytes and as many by rows.
    hot = (F.col("_rows") * F.col("_size") >= least) | (F.col("_rows") >= least_rows)
    found = rows.join(F.broadcast(chosen.where(hot).select(*KEY, "shard")), KEY, "left")
    others = found.where("shard is null").drop("shard").join(chosen.where(~hot).select(*KEY, "shard"), KEY)
    placed = saved(found.where("shard is not null").unionByName(others), "shard-placed")

    parts = max(1, math.ceil(count / ROWS_PER_SLOT_TASK), math.ceil(members / shards / ROWS_PER_SLOT_TASK))
    placed = placed.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int"))
    sizes = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard and ROWS_PER_SLOT_TASK rows.
    offsets = sizes.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_row"))
    return placed.withColumn("_inside", inside).join(offsets, ["shard", "_part"]).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("_offset") + F.col("_inside") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
