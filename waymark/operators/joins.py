"""Joins of large tables to dimensions and lookups, safe against one key holding most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from waymark.session import saved

# What one executor is asked to hold for a broadcast side.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is spread over one task for each such number of rows.
ROWS_PER_TASK = 1_000_000
# So many hot keys are kept in the plan; more of them are a table.
FEW_KEYS = 1000
# Values facts without a key are spread over.
NULL_SPREAD = 1 << 20


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hash of the columns, by default of all; maps have no hash and are left out."""
    kinds = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    return F.xxhash64(*[F.col(f"`{c}`") for c in (columns or df.columns) if "map<" not in kinds[c]])


def measures(df: DataFrame) -> list[Column]:
    """Rows and bytes of `df`, as aggregates that `within_bounds` judges."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return [F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("_bytes")]


def within_bounds(measured: Row) -> bool:
    return measured["_n"] <= BROADCAST_ROWS and measured["_bytes"] <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    """Whether `df`, measured, stays below both bounds."""
    return within_bounds(df.agg(*measures(df)).first())


def salted_join(
    facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", counts: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffled join in which the facts of frequent keys are spread over tasks.

    Every key with n facts above ROWS_PER_TASK gets ceil(n / ROWS_PER_TASK) salts, and only the rows of `other` for
    such a key are copied, once per salt: over all keys fewer than 2 x facts / ROWS_PER_TASK copies. Facts without a
    key are spread too. Without such keys it is a plain join. The salt is a hash of `spread_by`, so it comes out the same when a lost task is run
    again; name columns that tell the facts of a key apart, by default all. `counts` gives the number of
    facts per key in `_rows` where the caller has it. Streamed facts have no counts: they are joined as they are, whatever
    the size of `other`.
    """
    on = list(on)
    if facts.isStreaming:
        return facts.join(other, on, how)
    if counts is None:
        counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > ROWS_PER_TASK).select(*on, F.ceil(F.col("_rows") / ROWS_PER_TASK).cast("int").alias("_salts"))
    few = hot.limit(min(FEW_KEYS, BROADCAST_ROWS) + 1).collect()
    if not few:
        return facts.join(other, on, how)
    if len(few) <= min(FEW_KEYS, BROADCAST_ROWS):
        hot = F.broadcast(facts.sparkSession.createDataFrame(few, hot.schema))
    else:
        hot = saved(hot, "hot-keys")
        hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    content = content_hash(facts, spread_by)
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    salt = F.when(missing, -1 - F.pmod(content, F.lit(NULL_SPREAD))).otherwise(
        F.pmod(content, F.coalesce(F.col("_salts"), F.lit(1)))
    )
    salted = facts.join(hot, on, "left").withColumn("_salt", salt.cast("int")).drop("_salts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    copied = other.join(hot, on, "left").withColumn("_salt", each).drop("_salts")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def dimension_join(facts: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a dimension that may hold several rows per key: broadcast while its measured size allows, salted
    beyond that, or shuffled where the facts are a stream."""
    if fits_broadcast(dimension):
        return facts.join(F.broadcast(dimension), list(on), how)
    return salted_join(facts, dimension, on, how)


def group_join(facts: DataFrame, groups: DataFrame, on: Sequence[str], bound: int | None, how: str = "inner") -> DataFrame:
    """Join to a table of one row per group. `bound` is a measured bound on the number of groups; measuring `groups`
    itself would run the plan behind it twice. Without a bound the join is salted."""
    if bound is not None and bound <= BROADCAST_ROWS:
        return facts.join(F.broadcast(groups), list(on), how)
    return salted_join(facts, groups, on, how)
