"""Merkle manifest of a dataset: a tree per group of rows, a tree over the groups' roots, and each row's path to the root.

Leaves are ranked within their group and dealt out in aligned blocks. A block appends its leaves one by one to a row of
open subtrees; each open subtree has the partial witnesses of its leaves with it, and whenever its sibling is complete both sides' witnesses
grow by the other's root. The roots of the blocks are then appended like leaves, in blocks of their own, until one
node per group remains; a node's witness goes on with that of its block. The groups' roots make the last tree in the same way. No group is ever
in one task: a block has BLOCK nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import saved
from waymark.session import fix_partitions

LEVELS = 12
BLOCK = 1 << LEVELS
# A witness has one mark per level and the sibling's digest behind it, if there is one.
ON_LEFT, ON_RIGHT, ALONE = b"<", b">", b"="
POSITION_MASK = (1 << 33) - 1
MADE = "_group string, _at long, digest string, path binary"


def combined(*digests: str) -> str:
    """Digest of the digests' hexadecimal texts, one behind the other."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class OpenSubtrees:
    """An append-only tree that keeps, for every leaf, the witness up to the root of the subtree it lies in."""

    def __init__(self) -> None:
        self.paths: list[bytearray] = []
        # Level, root, first leaf; the leaves of one end where the next begins.
        self.open: list[tuple[int, str, int]] = []

    def append(self, digest: str) -> None:
        self.open.append((0, digest, len(self.paths)))
        self.paths.append(bytearray())
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def close(self, level: int | None = None) -> str:
        """The root, at `level` if stated: subtrees without a sibling are raised alone."""
        while len(self.open) > 1 or level is not None and self.open[0][0] < level:
            own, root, first = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == own:
                self._join()
                continue
            self.open[-1] = (own + 1, combined(root), first)
            for path in self.paths[first:]:
                path += ALONE
        return self.open[0][1]

    def _join(self) -> None:
        level, right, middle = self.open.pop()
        _, left, first = self.open.pop()
        for path in self.paths[middle:]:
            path += ON_LEFT + bytes.fromhex(left)
        for path in self.paths[first:middle]:
            path += ON_RIGHT + bytes.fromhex(right)
        self.open.append((level + 1, combined(left, right), first))


def steps(path: bytes) -> Iterator[tuple[str, str]]:
    """Digests to the left and to the right of the node, level by level; empty where there is none."""
    place = 0
    while place < len(path):
        mark = path[place:place + 1]
        place += 1
        sibling = ""
        if mark != ALONE:
            sibling = path[place:place + 32].hex()
            place += 32
        yield (sibling, "") if mark == ON_LEFT else ("", sibling)


def fold(digest: str, path: bytes) -> str:
    """The root that a digest and a path lead to."""
    for left, right in steps(path):
        digest = combined(left, digest, right)
    return digest


def siblings_digest(path: bytes) -> str:
    """Digest of the path's siblings in their order; of an empty text if there are none."""
    return combined(*[left + right for left, right in steps(path)])


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """Digest of the columns' texts, each behind its UTF-8 length and a colon; `-` for a missing value."""
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`_at`, the place within `_group` in the stated order, and `_size`, the group's rows; saved.

    Rows are range-partitioned, so a group that holds most rows spreads over many tasks; what precedes a task's rows of a group is one
    number per task and group. Rows equal in `order` are spread by the last column, whose values do not matter.
    """
    placed = rows.withColumn("_spread", F.monotonically_increasing_id())
    sort = ["_group", *order, "_spread"]
    fixed = fix_partitions(placed.repartitionByRange(*sort).sortWithinPartitions(*sort)).drop("_spread")
    marked = fixed.withColumns({"_part": F.spark_partition_id(), "_line": F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK))})
    sizes = saved(marked.groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("_rows"), F.min("_line").alias("_first")), "manifest-parts")
    along = Window.partitionBy("_group").orderBy("_part")
    offsets = sizes.select(
        "_part", "_group", (F.sum("_rows").over(along) - F.col("_rows") - F.col("_first")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("_group")).alias("_size"),
    )
    # Part and group: the parts of a group that holds most rows are keys of their own.
    found = marked.join(offsets, ["_part", "_group"])
    return saved(found.withColumn("_at", F.col("_line") + F.col("_before")).drop("_part", "_line", "_before"), "manifest-ranked")


def block_witnesses(nodes: DataFrame) -> DataFrame:
    """_group, _at, digest, path within the block, and on the block's first node the block's root."""

    def grow(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        block = block.sort_by("_at")
        subtrees = OpenSubtrees()
        for digest in block.column("digest").to_pylist():
            subtrees.append(digest)
        # Every block of a group with several is raised to one level; a block alone ends with its last node.
        root = subtrees.close(LEVELS if block.column("_size")[0].as_py() > BLOCK else None)
        return pa.table({
            "_group": block.column("_group"), "_at": block.column("_at"), "digest": block.column("digest"),
            "path": pa.array(list(map(bytes, subtrees.paths)), pa.binary()),
            "root": pa.array([root, *[None] * (len(block) - 1)], pa.string()),
        })

    return nodes.select("_group", "_at", "_size", "digest").groupBy(
        "_group", F.shiftright("_at", LEVELS).alias("_block"),
    ).applyInArrow(grow, f"{MADE}, root string")


def forest(nodes: DataFrame, above: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """_group, _at, digest, path and root of every node of a saved table with _group, _at, _size and digest.

    `above` gets the groups' roots (_group, digest) and gives them with a path to a common root and that root; the nodes' paths
    then go on to it.
    """
    made = saved(block_witnesses(nodes), "manifest-witnesses")
    roots = made.where(F.col("root").isNotNull()).select("_group", F.shiftright("_at", LEVELS).alias("_at"), F.col("root").alias("digest"))
    many = made.where(F.col("_at") >= BLOCK).limit(1).count() > 0
    if many:
        sizes = roots.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
        higher = forest(saved(roots.join(sizes, "_group"), "manifest-blocks"), above)
    elif above is not None:
        higher = above(roots.select("_group", "digest")).select("_group", F.lit(0).cast("long").alias("_at"), "path", "root", "subroot")
    else:
        higher = roots.select("_group", "_at", F.lit(b"").alias("path"), F.col("digest").alias("root"), F.col("digest").alias("subroot"))
    higher = higher.select("_group", F.col("_at").alias("_block"), F.col("path").alias("_further"), F.col("root").alias("_root"), "subroot")
    # At most BLOCK rows per group and block.
    joined = made.withColumn("_block", F.shiftright("_at", LEVELS)).join(higher, ["_group", "_block"])
    return joined.select("_group", "_at", "digest", F.concat("path", "_further").alias("path"), F.col("_root").alias("root"), "subroot")


def merkle_manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), by: str = "lang", id: str = "doc_id",
    keep: Column | None = None,
) -> DataFrame:
    """doc_id, position in its group, leaf, path, subroot and root of every row, and `kept` where `keep` is a column.

    Leaves of a group ascend by id, missing ids first, rows of one id by their digests (equal rows have equal leaves, and any of their places).
    Groups are ordered by the bytes of their name, the missing one first. Two consecutive nodes make the next; a last
    one without partner makes one alone. `path` has a mark per level and the sibling's 32 bytes behind it. An empty table gives no rows.
    """
    name = F.col(f"`{by}`").cast("string")
    leaves = docs.select(
        F.when(name.isNull(), "-").otherwise(F.concat(F.lit("="), name)).alias("_group"), F.col(f"`{id}`").alias("_id"),
        leaf_digest([f"`{c}`" for c in columns]).alias("digest"), (F.lit(None).cast("string") if keep is None else keep).alias("_kept"),
    )
    nodes = ranked(leaves, ["_id", "digest"])

    def above(subroots: DataFrame) -> DataFrame:
        own = subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "digest")
        top = ranked(own, ["_name"])
        tree = forest(top).select("_at", "path", "root", F.col("digest").alias("subroot"))
        return top.select("_at", F.col("_name").alias("_group")).join(tree, "_at")

    found = forest(nodes, above)
    kept = [] if keep is None else [F.col("_kept").alias("kept")]
    return nodes.select("_group", "_at", "_id", "_kept").join(found, ["_group", "_at"]).select(
        F.col("_id").alias("doc_id"), F.col("_at").alias("position"), F.col("digest").alias("leaf"), "path", "subroot", "root", *kept,
    )


def folded(manifest: DataFrame, leaf: str) -> DataFrame:
    """The manifest with proof_sha256 and folded_root, recomputed from the digest in column `leaf` and the row's path."""
    extra = [f for f in manifest.schema.fields if f.name != "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            leaves = batch.column(leaf).to_pylist()
            made = [list(map(siblings_digest, paths)), [fold(d, p) for d, p in zip(leaves, paths)]]
            names = [f.name for f in extra]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *[pa.array(m, pa.string()) for m in made]], names=[*names, "proof_sha256", "folded_root"])

    schema = manifest.drop("path").schema.add("proof_sha256", "string").add("folded_root", "string")
    return manifest.mapInArrow(run, schema)
