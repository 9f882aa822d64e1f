"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of a task's documents. Its words become numbers, the Burrows-Wheeler transform of their sequence
goes into a wavelet matrix, and all test windows are searched backward at once by its ranks; occurrences are
located by walking to the next sampled suffix position. Runs of words that all occur in the benchmark are the only
places where a window can be found, so the index holds just the runs at least as long as the shortest window; that
leaves out no occurrence.

The benchmark is sent to the tasks in blocks of at most BLOCK_BYTES of text, each against all documents; only where
there are several blocks are their findings put together per document.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Work, map_slices, pick, saved

WINDOW = 13
SAMPLE = 16
BLOCK_BYTES = 32 << 20
HIT_PARTS = 20  # contaminated from one word in so many
# Digits, letters and everything beyond ASCII make words; A-Z count as a-z.
WORD_BYTES = bytes(
    b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
FOUND = "doc_id long, _row long, n_words long, spans array<struct<first:long,past:long>>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in suffix order by prefix doubling. Zeros end a run: they differ from each other, the earlier is the lesser."""
    size = len(text)
    zeros = text == 0
    rank = text.astype(np.int64) + np.count_nonzero(zeros)
    rank[zeros] = np.arange(np.count_nonzero(zeros))
    step = 1
    while True:
        after = np.zeros(size, np.int64)
        after[:size - step] = rank[step:] + 1
        # What follows a zero does not matter, as its rank is already its own.
        key = rank * (size + int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(size, np.int64)
        ordered = key[order]
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if fresh[order[-1]] == size - 1 or step >= size:
            return order
        rank, step = fresh, step * 2


class WaveletMatrix:
    """Ranks of many symbols at many places at once."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.levels = max(1, int(largest).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bits = symbols >> level & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bits, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        start = np.zeros(len(symbol), np.int64)
        place = place.astype(np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            up, first = ones[place], ones[start]
            place = np.where(bit, zeros + up, place - up)
            start = np.where(bit, zeros + first, start - first)
        return place - start


class FMIndex:
    """Backward search over a sequence of runs of numbers from 1, each run between zeros."""

    def __init__(self, text: np.ndarray, largest: int) -> None:
        order = suffix_order(text)
        self.last = text[order - 1]
        self.ranks = WaveletMatrix(self.last, largest)
        counts = np.bincount(text, minlength=largest + 2)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # Every SAMPLE-th position and the first of each run, so that no walk leaves its run.
        known = np.zeros(len(text), bool)
        known[::SAMPLE] = True
        known[1:] |= text[:-1] == 0
        self.known, self.position = known[order], order

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows (one per row, all of one length) that occur, with their first and past-last places in suffix order."""
        alive = np.arange(len(windows))
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.last), np.int64)
        for column in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[alive, column]
            low = self.before[symbol] + self.ranks.rank(symbol, low)
            high = self.before[symbol] + self.ranks.rank(symbol, high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of places in suffix order."""
        place = place.copy()
        steps = np.zeros(len(place), np.int64)
        walking = np.flatnonzero(~self.known[place])
        while len(walking):
            symbol = self.last[place[walking]]
            place[walking] = self.before[symbol] + self.ranks.rank(symbol, place[walking])
            steps[walking] += 1
            walking = walking[~self.known[place[walking]]]
        return self.position[place] + steps


class Windows:
    """The distinct windows of a block of items, by length, and the items of each."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], size: int) -> None:
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            own = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            for start in range(max(1, len(own) - size + 1)) if own else ():
                found = owners.setdefault(own[start:start + size], set())
                if item is not None:
                    found.add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for length in sorted({len(w) for w in owners}):
            chosen = [w for w in owners if len(w) == length]
            self.by_length[length] = np.array(chosen, np.int64), [owners[w] for w in chosen]
        self.shortest = min(self.by_length, default=0)

    def runs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs without zeros at least as long as the shortest window, each followed by a zero, and where they were."""
        edges = np.diff(np.concatenate([[0], (numbers != 0).astype(np.int8), [0]]))
        first, past = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = past - first >= self.shortest
        first, past = first[long], past[long]
        sizes = past - first + 1
        ends = np.cumsum(sizes)
        origin = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)
        text = numbers[np.minimum(origin, len(numbers) - 1)] if len(origin) else np.zeros(0, np.int64)
        if len(ends):
            text[ends - 1] = 0
        return text, origin

    def find(self, numbers: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, list[set[str]]]]:
        """For each window length: the length, starts of occurrences, their windows, and the windows' items."""
        if not self.by_length:
            return []
        text, origin = self.runs(numbers)
        if not len(text):
            return []
        index = FMIndex(text, len(self.numbers))
        out = []
        for length, (windows, items) in self.by_length.items():
            window, low, high = index.search(windows)
            if len(window):
                sizes = high - low
                places = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
                out.append((length, origin[index.locate(places)], np.repeat(window, sizes), items))
        return out


def merged_spans(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


def find_block(rows: DataFrame, items: list[tuple[str | None, bytes | None]], size: int, keep: str | None) -> DataFrame:
    """What one block of items finds in each document: merged word spans and item ids."""
    content = rows.sparkSession.sparkContext.broadcast(items)

    def begin() -> Work:
        windows = Windows(content.value, size)
        number = windows.numbers.get

        def work(ids: list, texts: list[bytes | None], row: list[int]) -> list:
            words = [words_of(t) for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            # A zero after each document keeps windows from crossing over.
            past = np.cumsum(sizes + 1)
            numbers = np.zeros(int(past[-1]), np.int64)
            for own, end in zip(words, past):
                numbers[end - 1 - len(own):end - 1] = np.fromiter(map(number, own, repeat(0)), np.int64, len(own))
            hit = np.zeros(len(numbers) + 1, np.int64)
            items: dict[int, set[str]] = {}
            for length, starts, window, owners in windows.find(numbers):
                np.add.at(hit, starts, 1)
                np.add.at(hit, starts + length, -1)
                docs = np.searchsorted(past, starts, side="right")
                for doc, found in np.unique(np.stack([docs, window], 1), axis=0).tolist():
                    items.setdefault(doc, set()).update(owners[found])
            covered = np.cumsum(hit) > 0
            spans: list[list] = [[] for _ in ids]
            for doc in items:
                end = int(past[doc]) - 1
                spans[doc] = [{"first": a, "past": b} for a, b in merged_spans(covered[end - int(sizes[doc]):end])]
            return [ids, row, sizes.tolist(), spans, [sorted(items.get(i, ())) for i in range(len(ids))]]

        return work

    return map_slices(rows, begin, FOUND, keep=keep)


def merge_blocks(found: DataFrame) -> DataFrame:
    """Findings of several blocks per row: spans that touch or overlap become one."""
    start = F.expr("cast(array() as array<struct<first:bigint,past:bigint>>)")
    both = F.array_sort(F.flatten(F.collect_list("spans")))
    rows = found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), both.alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    step = F.aggregate("_spans", start, lambda done, span: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["past"] >= span["first"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["first"].alias("first"),
            F.greatest(F.element_at(done, -1)["past"], span["past"]).alias("past")))),
    ).otherwise(F.concat(done, F.array(span))))
    return rows.select("doc_id", "_row", "n_words", step.alias("spans"), "items")


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, keep: bool = False,
) -> DataFrame:
    """doc_id, n_words, spans of hit words, items, n_hit and contaminated of every document row.

    Missing and empty texts have no words and are never contaminated; an empty benchmark finds nothing. Items without
    id hit words but are not listed; items of one id count as one. Repeated rows are judged one by one. With `keep` the
    row itself is a last column `_doc`.
    """
    tests = pick(benchmark, item=item_id, text=item_text).select(F.col("item").cast("string"), "text").where("text is not null")
    total = tests.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    rows = pick(docs, keep, doc_id=id, text=text).select(
        F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"), *(["_doc"] if keep else [])
    )
    # The numbers follow the splits of the scan, which follow the cores alive; where the rows are read more than once they are made once.
    rows = saved(rows, "numbered") if blocks > 1 else rows
    # An item of more than a block would be a block of its own.
    numbered = saved(tests, "benchmark") if blocks > 1 else tests
    parts = []
    for block in range(blocks):
        # About block_bytes of text, by a hash of the item.
        own = numbered.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else numbered
        items = [(r["item"], r["text"].encode()) for r in own.toLocalIterator()]
        parts.append(find_block(rows, items, size, text) if keep and blocks == 1 else find_block(rows.drop("_doc"), items, size, None))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if blocks > 1:
        found = merge_blocks(found)
        found = found.join(rows.select("_row", "_doc"), "_row") if keep else found
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["past"] - span["first"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (HIT_PARTS * F.col("n_hit") >= F.col("n_words"))
    )


def items_digest(items: str = "items") -> tuple:
    """Number and SHA-256 of a document's items, in string order."""
    return F.size(items).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(items)).cast("binary"), 256).alias("items_sha256")
