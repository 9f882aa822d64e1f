"""Substring deduplication by content-defined chunks: a gear rolling hash cuts the texts, equal chunks are found by digest.

A cut depends only on the bytes before it, so the cuts of a passage are the same wherever it stands, and an insertion
moves only the cuts next to it. Of each repeated chunk the first occurrence (least id, row, place) stays. Neighbouring
repeated chunks with neighbouring first occurrences are a run. Each run is extended on the bytes of both texts, to the
exact ends of the passage. A run of at least `least_bytes` is removed, and so are runs that lie end to end and have
that length together; shorter ones are chance or stock phrases. Every removed byte repeats one of an earlier place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.bitmaps import bitmap, marked, parted
from waymark.llm.common import Work, map_slices, pick, saved
from waymark.operators.joins import salted_join

CUT_BITS = 5  # a cut after one byte in 32, behind the least length
LEAST_CHUNK = 16
MOST_CHUNK = 256
LEAST_SPAN = 120
CHUNKS = "doc_id long, _row long, n_bytes long, digests array<long>, ends array<int>"
SPANS = "array<struct<first:int,past:int>>"
CONTEXTS = "_row long, run int, side int, at int, from_row long, from_at int, context binary"
EXTENDED = "_row long, run int, side int, at int, from_row long, from_at int, reached int, open boolean"
# Bytes compared at each end of a run, and by how much more in every further round for ends that are equal so far.
REACH = 64
FURTHER = 16
# Ends are looked up in pieces of texts of this many bytes, so that a long text is not one task's work.
PIECE = 1 << 16
# Edges are many small Python objects: fewer at a time.
EDGE_BYTES = 1 << 19
EDGE_ROWS = 256


def gear_table(seed: int = 0) -> np.ndarray:
    """A random number for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """hash = 2 x hash before + number of the byte, modulo 2^32, at every place: the sum over the last 32 bytes, by doubling."""
    hashes = table[data]
    span = 1
    while span < 32:
        hashes[span:] += hashes[:-span] << np.uint32(span)
        span *= 2
    return hashes


def chunk_ends(data: np.ndarray, table: np.ndarray) -> list[int]:
    """Where the chunks of one text end; the last ends with the text."""
    size = len(data)
    ends, last = [], 0
    for cut in [*(np.flatnonzero(gear_hashes(data, table) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist(), size]:
        while cut - last > MOST_CHUNK:
            last += MOST_CHUNK
            ends.append(last)
        if cut - last >= LEAST_CHUNK or cut == size and cut > last:
            ends.append(cut)
            last = cut
    return ends


def chunk_texts(rows: DataFrame) -> DataFrame:
    """Digests and ends of every text's chunks."""

    def begin() -> Work:
        import xxhash

        table, digest = gear_table(), xxhash.xxh3_64_intdigest

        def work(ids: list, texts: list[bytes | None], row: list[int]) -> list:
            digests, ends = [], []
            for text in texts:
                cuts = chunk_ends(np.frombuffer(text, np.uint8), table) if text else []
                ends.append(np.array(cuts, np.int32))
                digests.append(np.array([digest(text[a:b]) for a, b in zip([0, *cuts], cuts)], np.uint64).view(np.int64))
            return [ids, row, [len(t or b"") for t in texts], digests, ends]

        return work

    return map_slices(rows, begin, CHUNKS)


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """_row, first and past of every chunk that occurs earlier, in this or another text, and the first occurrence's row and place."""
    digests = chunks.select(F.explode("digests").alias("digest"))
    repeated = saved(digests.groupBy("digest").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1").select("digest"), "repeated-digests")
    content = chunks.sparkSession.sparkContext.broadcast(bitmap(repeated, "digest"))

    def begin() -> Work:
        bits = content.value

        def work(ids: list, row: list[int], digests: list, ends: list) -> list:
            sizes = np.array([len(d) for d in digests], np.int64)
            if not sizes.sum():
                return [[]] * 5
            flat = np.concatenate([np.asarray(d, np.int64) for d in digests])
            past = np.concatenate([np.asarray(e, np.int64) for e in ends])
            text = np.repeat(np.arange(len(ids)), sizes)
            first = np.concatenate([[0], past[:-1]])
            first[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
            keep = np.flatnonzero(marked(bits, flat))
            doc = pa.array(ids, pa.int64()).take(pa.array(text[keep]))
            return [doc, np.array(row, np.int64)[text[keep]], flat[keep], first[keep], past[keep]]

        return work

    found = map_slices(chunks.select("doc_id", "_row", "digests", "ends"), begin, "doc_id long, _row long, digest long, first int, past int")
    found = saved(found.join(repeated, "digest"), "repeated-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "_row", "first")
    # Saved, so that the join has two plain shuffles and Spark may split a digest that is most of the rows.
    kept = saved(found.groupBy("digest").agg(F.min(place).alias("_kept")), "kept-chunks")
    later = found.join(kept, "digest").where((F.col("_row") != F.col("_kept._row")) | (F.col("first") != F.col("_kept.first")))
    return later.select("_row", "first", "past", F.col("_kept._row").alias("from_row"), F.col("_kept.first").alias("from_first"))


def in_runs(pieces: DataFrame, starts: Column) -> DataFrame:
    """`pieces` (of texts, by `first`) with `run`: a new number for each piece of a text where `starts` holds or nothing is before."""
    before = Window.partitionBy("_row").orderBy("first", "past")
    begins = F.when(starts, 1).otherwise(0)
    return pieces.withColumn("_begins", begins).withColumn("run", F.sum("_begins").over(before).cast("int")).drop("_begins")


def seed_runs(later: DataFrame) -> DataFrame:
    """Neighbouring chunks of a text whose first occurrences are neighbours too put together: _row, run, first, past, from_row, from_first."""
    before = Window.partitionBy("_row").orderBy("first", "past")
    shift = F.col("first") - F.col("from_first")
    follows = (F.lag("past").over(before) == F.col("first")) & (F.lag("from_row").over(before) == F.col("from_row")) & (F.lag(shift).over(before) == shift)
    runs = in_runs(later, ~F.coalesce(follows, F.lit(False))).groupBy("_row", "run")
    return runs.agg(F.min("first").alias("first"), F.max("past").alias("past"), F.min("from_row").alias("from_row"), F.min("from_first").alias("from_first"))


def run_edges(runs: DataFrame) -> DataFrame:
    """The left (side 0) and right end of every run, with its place in the first occurrence; not those at a text's start."""
    ends = F.array(
        F.struct(F.lit(0).alias("side"), F.col("first").alias("at"), F.col("from_first").alias("from_at")),
        F.struct(F.lit(1).alias("side"), F.col("past").alias("at"), (F.col("from_first") + F.col("past") - F.col("first")).alias("from_at")),
    )
    edges = runs.select("_row", "run", "from_row", F.explode(ends).alias("_end"))
    edges = edges.select("_row", "run", "_end.side", "_end.at", "from_row", "_end.from_at")
    return edges.where("side = 1 or (at > 0 and from_at > 0)")


def text_pieces(rows: DataFrame, size: int, reach: int) -> DataFrame:
    """Every text in pieces of `size` bytes and at least `reach` more at both ends: _row, piece, bytes, and start, where they begin."""
    data = F.col("text").cast("binary")
    start = lambda n: F.greatest(n * size - reach, F.lit(0))
    cut = lambda n: F.struct(F.substring(data, start(n) + 1, F.lit(size + 2 * reach)).alias("bytes"), start(n).alias("start"), n.alias("piece"))
    numbers = F.sequence(F.lit(0), F.floor(F.octet_length("text") / size).cast("int"))
    # The pieces are made before they are dealt out, or each would carry the whole text.
    pieces = rows.select("_row", F.explode(F.transform(numbers, cut)).alias("_piece"))
    return pieces.select("_row", "_piece.bytes", "_piece.start", "_piece.piece")


def contexts(rows: DataFrame, edges: DataFrame, reach: int) -> DataFrame:
    """The bytes outward of every edge, left ones backwards: of its own text, and once without `_row` of each place it is compared with."""
    size = max(PIECE, 2 * reach)
    piece = lambda at: F.floor(F.col(at) / size).cast("int").alias("piece")
    own = edges.groupBy("_row", piece("at")).agg(F.collect_list(F.struct("run", "side", "at", "from_row", "from_at")).alias("own"))
    lent = edges.groupBy(F.col("from_row").alias("_row"), piece("from_at")).agg(F.collect_set(F.struct("side", "from_at")).alias("lent"))
    needed = saved(own.join(lent, ["_row", "piece"], "full"), "edges")

    def begin() -> Work:
        def outward(text: bytes, side: int, at: int) -> bytes:
            return text[at:at + reach] if side else text[max(0, at - reach):at][::-1]

        def work(row: list[int], pieces: list[bytes], starts: list[int], own: list, lent: list) -> list:
            out = []
            for number, text, start, edges, places in zip(row, pieces, starts, own, lent):
                for e in edges or ():
                    context = outward(text, e["side"], e["at"] - start)
                    if context:
                        out.append((number, e["run"], e["side"], e["at"], e["from_row"], e["from_at"], context))
                for p in places or ():
                    out.append((None, None, p["side"], None, number, p["from_at"], outward(text, p["side"], p["from_at"] - start)))
            return [list(column) for column in zip(*out)] if out else [[]] * 7

        return work

    _, some = parted(rows.select("_row", "text"), needed, "_row")
    joined = text_pieces(some, size, reach).join(needed.hint("merge"), ["_row", "piece"]).select("_row", "bytes", "start", "own", "lent")
    return map_slices(joined, begin, CONTEXTS, slice_bytes=EDGE_BYTES, slice_rows=EDGE_ROWS)


def common_length(one: bytes, other: bytes) -> int:
    """How many first bytes are equal."""
    low, high = 0, min(len(one), len(other))
    if one[:high] == other[:high]:
        return high
    while low + 1 < high:
        middle = (low + high) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle
    return low


def extended(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """_row, run, and how many bytes outward of its left and right end are equal.

    A round compares a fixed number of bytes. Ends equal throughout go on in a further round with more bytes, until none is left.
    """

    def compare(reach: int) -> DataFrame:
        def begin() -> Work:
            def work(row: list, run: list, side: list, at: list, from_row: list, from_at: list, context: list, other: list) -> list:
                reached = [common_length(a, b) for a, b in zip(context, other)]
                return [row, run, side, at, from_row, from_at, reached, [r == reach for r in reached]]

            return work

        both = saved(contexts(rows, edges, reach), "contexts")
        place = ["from_row", "side", "from_at"]
        lent = both.where("_row is null").select(*place, F.col("context").alias("_other"))
        # A passage of many texts is one place; its edges are spread over tasks.
        joined = salted_join(both.where("_row is not null"), lent, place, spread_by=["_row", "run"])
        joined = joined.select("_row", "run", "side", "at", "from_row", "from_at", "context", "_other")
        return saved(map_slices(joined, begin, EXTENDED, widest=6), "extended")

    edges, reach = run_edges(runs), REACH
    out = compare(reach)
    rounds = out
    while not out.where("open").isEmpty():
        step = F.when(F.col("side") == 0, -F.col("reached")).otherwise(F.col("reached"))
        edges = out.where("open").select("_row", "run", "side", (F.col("at") + step).alias("at"), "from_row", (F.col("from_at") + step).alias("from_at"))
        reach *= FURTHER
        out = compare(reach)
        rounds = rounds.unionByName(out)
    of = lambda side: F.sum(F.when(F.col("side") == side, F.col("reached")).otherwise(0)).cast("int")
    return rounds.groupBy("_row", "run").agg(of(0).alias("left"), of(1).alias("right"))


def merged(spans: DataFrame) -> DataFrame:
    """Spans (_row, first, past) of a text that overlap or touch put together."""
    before = Window.partitionBy("_row").orderBy("first", "past").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("first") > F.max("past").over(before), F.lit(True))
    whole = in_runs(spans, apart).groupBy("_row", "run").agg(F.min("first").alias("first"), F.max("past").alias("past"))
    return whole.select("_row", "first", "past")


def long_spans(rows: DataFrame, later: DataFrame, least_bytes: int) -> DataFrame:
    """What goes of each text: runs that are long when extended, or long together; one row per text that has any."""
    runs = saved(seed_runs(later), "runs")
    longer = runs.join(extended(rows, runs), ["_row", "run"], "left").select(
        "_row", (F.col("first") - F.coalesce("left", F.lit(0))).alias("first"), (F.col("past") + F.coalesce("right", F.lit(0))).alias("past"),
    )
    long = F.col("past") - F.col("first") >= least_bytes
    spans = merged(merged(runs.select("_row", "first", "past")).where(long).unionByName(longer.where(long)))
    return spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("first", "past"))).alias("spans"))


def whole_characters(text: bytes, first: int, past: int) -> tuple[int, int]:
    """The span without the characters that only lie in it in part."""
    while first < past and text[first] & 0xC0 == 0x80:
        first += 1
    while past > first and past < len(text) and text[past] & 0xC0 == 0x80:
        past -= 1
    return first, past


def remove_repeats(docs: DataFrame, least_bytes: int = LEAST_SPAN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text without repeated spans, n_bytes, n_removed and spans (byte offsets in the original) of every row.

    Missing texts stay missing, empty ones empty; neither has spans. Of repeated rows all but one lose their whole text
    where it is long enough. A missing id counts as the greatest. A span leaves characters that it holds in part.
    """
    numbered = pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"))
    # The numbers follow the splits of the scan, which follow the cores alive; they are made once.
    rows = saved(numbered, "numbered")
    chunks = saved(chunk_texts(rows), "chunks")
    spans = saved(long_spans(rows, repeated_chunks(chunks), least_bytes), "spans")

    def begin() -> Work:
        def work(ids: list, texts: list[bytes | None], spans: list) -> list:
            out, sizes, gone = [], [], []
            for text, own in zip(texts, spans):
                kept, last, cut = [], 0, []
                for span in own or ():
                    first, past = whole_characters(text, span["first"], span["past"])
                    if past - first >= least_bytes:
                        kept.append(text[last:first])
                        last = past
                        cut.append({"first": first, "past": past})
                out.append(None if text is None else b"".join([*kept, text[last:]]).decode())
                sizes.append(len(text or b""))
                gone.append(cut)
            return [ids, out, sizes, [sum(s["past"] - s["first"] for s in cut) for cut in gone], gone]

        return work

    # Texts without spans stay where they are. The others are always shuffled: their number grows with the table.
    without, some = parted(rows, spans, "_row")
    cut = map_slices(
        some.join(spans.hint("merge"), "_row", "left").select("doc_id", "text", "spans"), begin,
        f"doc_id long, text string, n_bytes long, n_removed long, spans {SPANS}",
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return cut.unionByName(without.select("doc_id", "text", size, F.lit(0).cast("long").alias("n_removed"), F.expr(f"cast(array() as {SPANS})").alias("spans")))
