"""The first n rows per group, and random samples, without sorting a group in one task.

Rows are ordered by a count, highest first, and among equal counts by a hash of their key. The sizes of all
counts give the count at which the n-th row lies; among the rows of that count, and only for them, the
sizes of hash slots give the slot in which it lies. Everything before that slot is kept and dealt out evenly, and only
the slot, about 1/16**DIGITS of the group, is ranked. A group has few distinct counts (k of them need k*k/2
rows of log, so `count` must count rows) and 16**DIGITS slots, so the tables of sizes are small.

A small random sample needs none of this: every task keeps its least rows, and those are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.text import row_hash
from waymark.operators.joins import group_join

# Hex digits of the hash that make a slot.
DIGITS = 4
# Samples up to this size are kept as the least rows of each task; Spark cuts a task's rows to so many before they are shuffled.
TASK_ROWS = 1000
# Tasks' rows meet in so many parts of a group first, so that no task gets those of all tasks.
TASK_PARTS = 256
# Numbers that decided rows are dealt out by.
SPREAD = 1 << 30


def check_size(n: int | None, argument: str = "sample") -> None:
    if n is not None and (isinstance(n, bool) or not isinstance(n, int) or n < 0):
        raise ValueError(f"{argument} must be a count or None, not {n!r}")


def _last(sizes: DataFrame, by: list[str], order: Sequence[str | Column], n: int, start: Column) -> DataFrame:
    """The entry of each group in which its n-th row lies, or its last one, and the rows before it."""
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    reached = sizes.withColumn("_before", start + F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    return reached.where(F.col("_before") < n).groupBy(*by).agg(F.max_by(F.struct("_entry", "_before"), "_before").alias("_last"))


def _attach(rows: DataFrame, last: DataFrame, by: list[str], groups: int | None) -> DataFrame:
    return group_join(rows, last, by, groups) if by else rows.withColumn("_last", last.scalar())


def _least_rows(df: DataFrame, n: int, key: list[str], ties: list[str], extra: list[str]) -> DataFrame:
    """The `n` rows of least hash per group, in one pass: the least of each task, then of some tasks, then of all."""
    hashed = df.withColumn("_hash", row_hash(ties, *extra))
    if not key:
        return hashed.orderBy("_hash", *ties).limit(n)
    parts = hashed.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(TASK_PARTS)))
    for group in ([*key, "_part"], key):
        place = F.row_number().over(Window.partitionBy(*group).orderBy("_hash", *ties))
        parts = parts.withColumn("_place", place).where(F.col("_place") <= n)
    return parts


def first_n(
    df: DataFrame, n: int | None, by: Sequence[str] = (), count: str | None = None,
    tie_columns: Sequence[str] | None = None, seed: int | None = None, copies: str | None = None,
    groups: int | None = None, hashed: str | None = None,
) -> DataFrame:
    """The first `n` rows of each group in `by`, by `count` descending, then by hash of `tie_columns`.

    `copies` names a column saying how many equal rows a row stands for; they count towards `n`, and the
    column comes back as the number taken. The tie columns must otherwise tell rows of a group apart.
    `groups` is an upper bound on the number of groups, where the caller knows one. `hashed` names a column that holds the hash of
    the tie columns already, which then need not be there.
    """
    check_size(n)
    if n is None:
        return df
    if n == 0:
        return df.limit(0)
    columns, key = df.columns, ["_group"] if by else []
    ties = [hashed] if hashed else list(tie_columns or [c for c in columns if c not in (*by, count, copies)])
    # As a struct, missing group values are equal to each other and join like any other.
    df = df.withColumn("_group", F.struct(*by)) if by else df
    amount = F.col(copies) if copies else F.lit(1)
    extra = [] if seed is None else [str(seed)]

    if not count and not copies and not hashed and n <= TASK_ROWS:
        return _least_rows(df, n, key, ties, extra).select(*columns)
    if count:
        sizes = df.groupBy(*key, F.col(count).alias("_entry")).agg(F.sum(amount).alias("_size"))
        edges = _last(sizes, key, [F.desc("_entry")], n, F.lit(0))
        near = _attach(df, edges, key, groups).where(F.col(count) >= F.col("_last._entry"))
        near = near.withColumns({"_tied": F.col(count) == F.col("_last._entry"), "_above": F.col("_last._before")}).drop("_last")
    else:
        near = df.withColumns({"_tied": F.lit(True), "_above": F.lit(0).cast("bigint")})
    placed = near.withColumn("_hash", F.when(F.col("_tied"), F.col(hashed) if hashed else row_hash(ties, *extra)))
    slotted = placed.withColumn("_slot", F.substring("_hash", 1, DIGITS))

    tied = slotted.where("_tied").groupBy(*key, F.col("_slot").alias("_entry"))
    slots = tied.agg(F.sum(amount).alias("_size"), F.max("_above").alias("_above"))
    kept = _attach(slotted, _last(slots, key, ["_entry"], n, F.col("_above")), key, groups)
    kept = kept.where(~F.col("_tied") | (F.col("_slot") <= F.col("_last._entry")))
    # Rows of the slot, the only ones to be ranked, meet in one task. All others are decided; a number of their own keeps
    # them apart, so that the window neither gathers nor sorts them.
    within = F.col("_tied") & (F.col("_slot") == F.col("_last._entry"))
    kept = kept.withColumn("_apart", F.when(within, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*ties), F.lit(SPREAD))))
    in_slot = Window.partitionBy(*key, "_apart").orderBy("_rank_hash", *ties).rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.withColumn("_rank_hash", F.when(within, F.col("_hash")))
    room = F.lit(n) - F.col("_last._before") - F.coalesce(F.sum(amount).over(in_slot), F.lit(0))
    taken = kept.withColumn("_taken", F.when(within, F.least(amount, room)).otherwise(amount)).where(F.col("_taken") > 0)
    if copies:
        taken = taken.withColumn(copies, F.col("_taken"))
    return taken.select(*columns)


def order_by_count(df: DataFrame, count: str = "search_query_counts") -> DataFrame:
    """Most repeated rows first, ties by all other columns."""
    return df.orderBy(F.desc(count), *[c for c in df.columns if c != count])


def random_sample(
    df: DataFrame, n: int | None, seed: int = 0, by: Sequence[str] = (), id_columns: Sequence[str] | None = None,
    groups: int | None = None,
) -> DataFrame:
    """`n` rows (of each group in `by`) in the order of a seeded hash; fewer where there are fewer.

    With `id_columns`, which must tell rows apart, each row is drawn on its own. Without them the hash is of
    the whole row: exact copies are counted together first, so a row repeated in bulk is one entry.
    """
    check_size(n)
    if n is None:
        return df
    if id_columns is not None:
        return first_n(df, n, by, tie_columns=id_columns, seed=seed, groups=groups)
    columns = df.columns
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    ties = [c for c in columns if c not in by]
    taken = first_n(distinct, n, by, tie_columns=ties, seed=seed, copies="_copies", groups=groups)
    each = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return taken.select(*columns, each).drop("_copy")
