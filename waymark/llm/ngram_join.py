"""N-gram Jaccard join with adaptive multi-match prefixes.

All documents' shingles are put in one order, rare ones first. Two sets similar enough share at least k shingles among their first
size - needed + k ones, for every k. Each document chooses its k by estimated cost: a longer prefix touches
longer lists, but a partner must then share k of its shingles before it is verified. A pair uses the lesser k of the two.

1. One pass counts shingles in a sketch of fixed size, which gives the order (it decides about cost only, never about
   results), and a digest of each document's set. Documents of equal sets are one class from here on.
2. One pass gives each class its longest prefix. Its shingles are shuffled packed; those of one class alone go. The
   lengths of the lists that are left tell each class's cost for every k, and it keeps the prefix of the cheapest.
3. Each class is compared with one hub, the class that it shares most lists' least members with. Classes so
   connected need no comparison with each other, so large groups of near copies cost one comparison per member.
4. All pairs of different components that share enough of their prefixes are verified on their whole sets.

Sets are sets of 64-bit hashes of shingles.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.bitmaps import bitmap, marked
from waymark.llm.common import Work, ascii_words, map_slices, pick, saved
from waymark.llm.components import components

SHINGLE, PERCENT = 5, 80
SKETCH_BITS = 22
SKETCH_PARTS = 64
MEMO_WORDS = 400_000
SEEN_CLASSES = 200_000
SLICE = 16 << 20
POSTINGS_PER_BUCKET = 250_000
HOT_LIST = 20_000
POSTING_SHARE = 200  # a posting costs as much as comparing so many shingles
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio, odd


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before."""

    def __init__(self) -> None:
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.hash(word)
        return value


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word n-grams; a shorter text is one n-gram, one without words none."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.words = WordHashes()
        odd = np.random.default_rng(size).integers(1 << 62, 1 << 63, size)
        self.factors = [np.uint64((2 * int(n) + 1) & (2**64 - 1)) for n in odd]

    def _mixed(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """A hash of every run of `size` words, and of the size."""
        mixed = np.full(len(hashes) - size + 1, size, np.uint64)
        for place in range(size):
            mixed += hashes[place:len(hashes) - size + 1 + place] * self.factors[place]
        for shift in (30, 27, 31):
            mixed ^= mixed >> np.uint64(shift)
            mixed *= MULTIPLIER
        mixed ^= mixed >> np.uint64(32)
        return mixed

    def of(self, texts: list[bytes | None]) -> list[np.ndarray]:
        words = [ascii_words(t) for t in texts]
        if len(self.words) > MEMO_WORDS:
            self.words.clear()
        sizes = [len(w) for w in words]
        hashes = np.fromiter(map(self.words.__getitem__, chain.from_iterable(words)), np.uint64, sum(sizes))
        # All runs at once; those that reach into the next text are left out below.
        runs = self._mixed(hashes, self.size) if len(hashes) >= self.size else hashes[:0]
        out, first = [], 0
        for size in sizes:
            if size >= self.size:
                own = np.sort(runs[first:first + size - self.size + 1])
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            else:
                out.append(self._mixed(hashes[first:first + size], size) if size else hashes[:0])
            first += size
        return out


def class_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def needed(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The fewest shingles that any similar partner shares with a set of this size."""
    return -(-size * percent // 100)


def sketch(rows: DataFrame, shingle: int) -> tuple[DataFrame, np.ndarray]:
    """Saved rows (doc_id, n, cls; cls is null without words), and the sketch as eighths of octaves of estimated counts."""

    def begin() -> Work:
        shingles, counts = Shingles(shingle), np.zeros(1 << SKETCH_BITS, np.uint32)

        def work(ids: list | None = None, texts: list[bytes | None] | None = None) -> list:
            if ids is None:
                parts = counts.reshape(SKETCH_PARTS, -1)
                none = [None] * SKETCH_PARTS
                return [none, none, none, list(range(SKETCH_PARTS)), [zlib.compress(p.tobytes(), 1) for p in parts]]
            sets = shingles.of(texts)
            low = np.concatenate(sets) & np.uint64((1 << SKETCH_BITS) - 1)
            np.add.at(counts, low.astype(np.int64), np.uint32(1))
            none = [None] * len(ids)
            return [ids, [len(s) for s in sets], [class_of(s) if len(s) else None for s in sets], none, none]

        return work

    schema = "doc_id long, n long, cls binary, part int, counts binary"
    both = saved(map_slices(rows.select("doc_id", "text"), begin, schema, end=True), "shingle-counts")

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64)
                sums[part] = sums[part] + own if part in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["part", "counts"])

    # One table of fixed size per task; added up part by part.
    added = both.where("part is not null").select("part", "counts").repartition(SKETCH_PARTS, "part").mapInArrow(add, "part int, counts binary")
    scale = np.zeros(1 << SKETCH_BITS, np.int64)
    size = len(scale) // SKETCH_PARTS
    for part, data in added.toLocalIterator():
        scale[part * size:(part + 1) * size] = np.frombuffer(data, np.int64)
    # Other shingles of the same cell stand for the mean; what is within three deviations of it counts as nothing.
    mean = float(np.median(scale))
    excess = np.maximum(scale - (mean + 3 * math.sqrt(mean)), 0)
    return both.where("part is null").select("doc_id", "n", "cls"), np.minimum(np.log2(1 + excess) * 8, 255).astype(np.uint8)


def most_shared(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The greatest k asked for: up to half as many shingles more in the prefix as for k = 1."""
    return np.minimum(needed(size, percent), 1 + (size - needed(size, percent)) // 2)


def choose_k(places: np.ndarray, others: np.ndarray, size: int, percent: int) -> int:
    """How many shared shingles to ask for, by estimated cost.

    `places` are those of the set's shingles that `others` more classes have in their prefixes. With partners of its
    own size the prefix for k touches the lists of its first shingles, and at most touched / k partners are in k of them.
    """
    first = size - -(-2 * percent * size // (100 + percent))
    k = np.arange(1, int(most_shared(size, percent)) + 1)
    inside = places < first + len(k)
    touched = np.bincount(np.maximum(places[inside] - first, 0), others[inside], len(k)).cumsum()
    return int(np.argmin(touched + touched / k * (1 + size / POSTING_SHARE))) + 1


def prefixes(rows: DataFrame, shingle: int, percent: int, scale: np.ndarray) -> DataFrame:
    """id, cls, n, the longest prefix (bytes of hashes in order) and a text's key of every class of equal sets; saved."""
    content = rows.sparkSession.sparkContext.broadcast(scale)

    def begin() -> Work:
        shingles, scale, seen = Shingles(shingle), content.value, set()

        def work(texts: list[bytes | None], keys: list[int]) -> list:
            columns: list[list] = [[] for _ in range(4)]
            for own, key in zip(shingles.of(texts), keys):
                if not len(own) or (cls := class_of(own)) in seen:
                    continue
                if len(seen) > SEEN_CLASSES:
                    seen.clear()
                seen.add(cls)
                rank = scale[(own & np.uint64(len(scale) - 1)).astype(np.int64)]
                order = np.argsort(rank, kind="stable")
                length = len(own) - needed(len(own), percent) + int(most_shared(len(own), percent))
                for column, value in zip(columns, (cls, len(own), own[order[:length]].tobytes(), key)):
                    column.append(value)
            return columns

        return work

    keyed = rows.select("text", F.xxhash64("text").alias("_key"))
    found = map_slices(keyed, begin, "cls binary, n int, prefix binary, key long", widest=0)
    # `key` is the hash of one text of the class; it finds the set's text again.
    classes = found.groupBy("cls").agg(*[F.first(c).alias(c) for c in ("n", "prefix")], F.min("key").alias("key"))
    return saved(classes.withColumn("id", F.monotonically_increasing_id()), "shingle-classes")


def shared_postings(classes: DataFrame, scale: np.ndarray) -> DataFrame:
    """token, id, n, place and others of the prefix shingles that more than one class has.

    `others` is how many more classes have it in their prefixes; for the hottest ones, which are dealt out by class
    instead of by shingle, the sketch's estimate.
    """
    content = classes.sparkSession.sparkContext.broadcast(scale)
    total = classes.agg(F.coalesce(F.sum(F.octet_length("prefix")), F.lit(0)) / 8).first()[0]
    buckets = max(256, math.ceil(total / POSTINGS_PER_BUCKET))
    hot_rank = int(math.log2(1 + HOT_LIST) * 8)

    def begin() -> Work:
        scale = content.value

        def work(prefix: list[bytes], ids: list[int], n: list[int]) -> list:
            sizes = np.array([len(p) // 8 for p in prefix], np.int64)
            tokens = np.frombuffer(b"".join(prefix), np.uint64)
            doc = np.repeat(np.arange(len(ids)), sizes)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bucket = (tokens >> np.uint64(24)).astype(np.int64) % buckets
            hot = scale[(tokens & np.uint64(len(scale) - 1)).astype(np.int64)] >= hot_rank
            bucket[hot] = -1 - (doc[hot] + place[hot]) % buckets
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order][:1] - 1)) if len(order) else []
            packed = np.stack([np.array(ids, np.int64)[doc], np.array(n, np.int64)[doc], place])[:, order]
            tokens = tokens[order]
            out: list[list] = [[], [], []]
            for first, past in zip(edges, [*edges[1:], len(order)]):
                out[0].append(int(bucket[order[first]]))
                out[1].append(tokens[first:past].tobytes())
                # Classes ascend, so their steps are small.
                own = packed[:, first:past].copy()
                own[0] = np.diff(own[0], prepend=0)
                out[2].append(zlib.compress(own.tobytes(), 1))
            return out

        return work

    packed = map_slices(classes.select("prefix", "id", "n"), begin, "bucket int, tokens binary, rest binary", widest=0, slice_bytes=SLICE)

    def unpack(key: tuple, table: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), np.uint64)
        rest = [np.frombuffer(zlib.decompress(r), np.int64).reshape(3, -1) for r in table["rest"].to_pylist()]
        ids = np.concatenate([np.cumsum(r[0]) for r in rest])
        _, n, place = np.concatenate(rest, axis=1)
        if key[0].as_py() >= 0:
            _, number, count = np.unique(tokens, return_inverse=True, return_counts=True)
            others = count[number] - 1
        else:
            ranks = content.value[(tokens & np.uint64(len(content.value) - 1)).astype(np.int64)]
            others = (2.0 ** (ranks / 8)).astype(np.int64)
        shared = others > 0
        return pa.table({
            "token": tokens[shared].view(np.int64), "id": ids[shared], "n": n[shared].astype(np.int32),
            "place": place[shared].astype(np.int32), "others": others[shared].astype(np.int32),
        })

    return packed.groupBy("bucket").applyInArrow(unpack, "token long, id long, n int, place int, others int")


def chosen_postings(shared: DataFrame, percent: int) -> DataFrame:
    """The postings of each class's own prefix, saved: token, id, n, k, place, lone and most.

    `lone` counts the class's shingles before it that no other
    class has in its prefix: no partner that shares this shingle has them. So a partner shares at most n - lone
    shingles, and has at most `most` itself.
    """

    def begin() -> Work:
        def work(ids: list[int], sizes: list[int], postings: list) -> list:
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for id, size, own in zip(ids, sizes, postings):
                place, others, token = np.array(sorted((p["place"], p["others"], p["token"]) for p in own), np.int64).T
                k = choose_k(place, others, size, percent)
                lone = place - np.arange(len(place))
                most = (size - lone) * (100 + percent) // percent - size
                inside = place < size - needed(size, percent) + k
                number = int(inside.sum())
                for column, values in zip(out, (
                    token[inside], np.full(number, id), np.full(number, size), np.full(number, k), place[inside], lone[inside], most[inside],
                )):
                    column.append(values)
            return [np.concatenate(column).astype(np.int64 if n < 2 else np.int32) for n, column in enumerate(out)]

        return work

    by_class = shared.groupBy("id").agg(F.first("n").alias("n"), F.collect_list(F.struct("place", "others", "token")).alias("postings"))
    schema = "token long, id long, n int, k int, place int, lone int, most int"
    return saved(map_slices(by_class, begin, schema, slice_rows=256), "postings")


def whole_sets(rows: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """id and the whole set (bytes) of the given classes (id, cls, key). Only texts whose key is among theirs are read into sets."""
    content = rows.sparkSession.sparkContext.broadcast(bitmap(classes, "key"))

    def begin() -> Work:
        shingles, seen = Shingles(shingle), set()

        def work(texts: list[bytes | None], keys: list[int]) -> list:
            chosen = np.flatnonzero(marked(content.value, np.array(keys, np.int64)))
            found: dict[bytes, bytes] = {}
            for own in shingles.of([texts[i] for i in chosen]):
                if len(own) and (cls := class_of(own)) not in seen:
                    if len(seen) > SEEN_CLASSES:
                        seen.clear()
                    seen.add(cls)
                    found[cls] = own.tobytes()
            return [list(found), list(found.values())]

        return work

    keyed = rows.select("text", F.xxhash64("text").alias("_key"))
    sets = map_slices(keyed, begin, "cls binary, shingles binary", widest=0).groupBy("cls").agg(F.first("shingles").alias("shingles"))
    return sets.join(classes.select("id", "cls"), "cls").select("id", "shingles")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar enough."""

    def begin() -> Work:
        def work(left: list[bytes], right: list[bytes], a: list[int], b: list[int]) -> list:
            good = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common >= percent * (len(both) - common))
            return [[v for v, ok in zip(a, good) if ok], [v for v, ok in zip(b, good) if ok]]

        return work

    sets = saved(sets, "shingle-sets")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_right"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return map_slices(joined.select("_left", "_right", "a", "b"), begin, "a long, b long", widest=0)


def may_match(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Whether a shingle shared by two classes counts for them: it is in both prefixes for the overlap that their sizes
    ask for and the lesser k, and what can be shared before and behind it is enough."""
    overlap = F.ceil(F.lit(percent) * (a["n"] + b["n"]) / (100 + percent))
    k = F.least(a["k"], b["k"])
    inside = (a["place"] < a["n"] - overlap + k) & (b["place"] < b["n"] - overlap + k)
    before = F.least(a["place"] - a["lone"], b["place"] - b["lone"])
    return inside & (before + F.least(a["n"] - a["place"], b["n"] - b["place"]) >= overlap)


def hub_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """For each class that shares lists, one other: the one that is most often the hub of its size in those lists.

    A list's hub is the class with the fewest lone shingles there, such as the text that copies were made from. Pairs
    that do not share the lesser k of their prefixes in such lists are left to `cross_pairs`.
    """
    band = F.floor(F.log("n") / (2 * math.log(100 / percent))).cast("int") if percent < 100 else F.col("n")
    banded = postings.withColumn("_band", band)
    hub = F.min(F.struct("lone", "id", "n", "k", "place"))
    hubs = banded.groupBy("token", "_band").agg(hub.alias("_hub"), F.count(F.lit(1)).alias("_size"))
    own, other = ({c: F.col(f"{of}{c}") for c in ("n", "k", "place", "lone")} for of in ("", "_hub."))
    near = banded.join(hubs.where("_size > 1").drop("_size"), ["token", "_band"]).where(
        (F.col("id") != F.col("_hub.id")) & may_match(own, other, percent)
    )
    counted = near.groupBy(F.col("id").alias("a"), F.col("_hub.id").alias("_b")).agg(
        F.count(F.lit(1)).alias("_times"), F.first(F.least("k", "_hub.k")).alias("_k"))
    best = counted.where("_times >= _k").groupBy("a").agg(F.max(F.struct("_times", (-F.col("_b")).alias("_less"))).alias("_best"))
    return best.select("a", (-F.col("_best._less")).alias("b"))


def cross_pairs(postings: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components that share at least the lesser k of their prefix shingles.

    The smaller of two similar sets can have a partner of its own size or more (`most` >= n). A class that cannot stays
    in a list only if such a one small enough is there too. Of two classes in different components at least one is
    outside the list's main component, so the members of that one never meet each other.
    """
    strong = F.when(F.col("most") >= F.col("n"), F.col("n"))
    least = postings.groupBy("token").agg(F.min(strong).alias("_strong"), F.count(F.lit(1)).alias("_size"))
    useful = postings.join(least.where("_strong is not null and _size > 1").drop("_size"), "token").where("most >= _strong").drop("_strong")
    rooted = useful.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")
    rooted = saved(rooted, "rooted-lists")
    sizes = rooted.groupBy("token", "root").agg(F.count(F.lit(1)).alias("_size"))
    mixed = sizes.groupBy("token").agg(F.max(F.struct("_size", "root")).alias("_main"), F.count(F.lit(1)).alias("_roots")).where("_roots > 1")
    lists = saved(rooted.join(mixed.select("token", F.col("_main.root").alias("_main")), "token"), "mixed-lists")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("token", *[F.col(c).alias(f"{c}_{name}") for c in ("id", "root", "_main", "n", "k", "place", "lone")])

    a, b = ({c: F.col(f"{c}_{of}") for c in ("n", "k", "place", "lone")} for of in "ab")
    once = (F.col("root_b") == F.col("_main_b")) | (F.col("id_a") < F.col("id_b"))
    pairs = side(lists.where("root <> _main"), "a").join(side(lists, "b"), "token").where(
        (F.col("root_a") != F.col("root_b")) & once & may_match(a, b, percent)
    )
    # Which one is on side a differs from list to list; a pair is counted over all of its lists.
    counted = pairs.groupBy(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).agg(
        F.count(F.lit(1)).alias("_times"), F.first(F.least("k_a", "k_b")).alias("_k"), F.first(F.col("n_a") + F.col("n_b")).alias("_sizes"),
        F.min(F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))).alias("_behind"),
    )
    # What is shared up to the last common prefix shingle is known; behind it, at most what the shorter rest has.
    enough = (F.col("_times") + F.col("_behind") - 1) * (100 + percent) >= percent * F.col("_sizes")
    return counted.where((F.col("_times") >= F.col("_k")) & enough).select("a", "b")


def similar_groups(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (digest of the set, in hex) of every row.

    Two rows are linked when 100 x common >= percent x all shingles; component_id is the least doc_id reachable. Rows
    without words are alone. Repeated rows, also of one doc_id, are separate rows with equal sets. A missing doc_id is
    never the least; a group of such rows alone has no component_id.
    """
    rows = pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text")
    members, scale = sketch(rows, shingle)
    classes = prefixes(rows, shingle, percent, scale)
    postings = chosen_postings(shared_postings(classes, scale), percent)

    def links(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are similar; only sets of classes in pairs are made again and shuffled."""
        pairs = saved(pairs, "pairs")
        ids = pairs.select("a").union(pairs.select("b")).distinct()
        wanted = saved(ids.join(classes.select("id", "cls", "key"), F.col("a") == F.col("id")).drop("a"), "pair-classes")
        return saved(verified(pairs, whole_sets(rows, wanted, shingle), percent), "links")

    near = links(hub_pairs(postings, percent))
    roots = components(near)
    more = links(cross_pairs(postings, roots, percent))
    if not more.isEmpty():
        roots = components(near.unionByName(more))
    of_class = classes.select("cls", F.col("id").alias("node")).join(roots, "node", "left").select("cls", F.coalesce("root", "node").alias("root"))
    grouped = members.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("_least")).join(of_class, "cls")
    least = grouped.groupBy("root").agg(F.min("_least").alias("component_id"))
    found = grouped.join(least, "root").select("cls", "component_id")
    linked = members.where("cls is not null").join(found, "cls")
    alone = members.where("cls is null").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.lower(F.hex("cls")).alias("class_id"))
