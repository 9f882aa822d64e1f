"""Best-fit packing into token sequences: a fixed number of open bins, found by a bitset of their free space.

Only documents longer than a sequence are cut, so that all pieces but the first fill a sequence. The others are packed
online in each task: a piece goes to the open bin with the least sufficient space; where none has room and all
places are taken, the fullest bin closes. Tasks get pieces by a hash of the row, about PIECES_PER_TASK each, so
the bins left open at a task's end are few against those it fills.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.llm.common import Work, map_slices, pick, saved
from waymark.llm.token_counts import byte_symbols, read_vocabulary

LENGTH = 2048
OPEN_BINS = 256
PIECES_PER_TASK = 100_000
END_ID = 0
# Texts of these characters are split alike by both libraries; anything else goes to the slower one.
PLAIN = re.compile("[\t\n\r -~¡-ſ]*")
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, _row long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Encoder:
    """Ids of a text without special tokens added, equal to the tokenizers library for the same file."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        model = json.loads(vocabulary)
        special = {t["content"] for t in model["added_tokens"]}
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in special}
        self.special = [s for s in special]
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces_of(size: int, length: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; the first takes what does not fill a sequence."""
    first = size % length or length
    return [(0, first), *[(start, length) for start in range(first, size, length)]]


class OpenBins:
    """At most `places` open bins; `free` has bit s set while a bin with s free places is open."""

    def __init__(self, length: int, places: int) -> None:
        self.length, self.places = length, places
        self.free = 0
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.count = self.made = 0

    def put(self, size: int) -> tuple[int, int]:
        """The bin's number and the offset in it."""
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            bin = self._take(space)
        else:
            if self.count == self.places:
                self._take((self.free & -self.free).bit_length() - 1)
            space, bin = self.length, self.made
            self.made += 1
        left = space - size
        if left:
            self.bins[left].append(bin)
            self.free |= 1 << left
            self.count += 1
        return bin, self.length - space

    def _take(self, space: int) -> int:
        bins = self.bins[space]
        bin = bins.pop()
        if not bins:
            self.free &= ~(1 << space)
        self.count -= 1
        return bin


def token_pieces(docs: DataFrame, vocabulary: str | None, id: str, text: str, length: int) -> DataFrame:
    """The pieces of every document with their checksums; `_row` tells repeated documents apart."""
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary, "byte_bpe_50k.json"))

    def begin() -> Work:
        encoder = Encoder(content.value)

        def work(ids: list, texts: list[bytes | None], rows: list[int]) -> list:
            out: list[list] = [[] for _ in range(6)]
            for doc, text, row in zip(ids, texts, rows):
                tokens = np.append(encoder.ids((text or b"").decode()), np.array([END_ID], "<u4"))
                for number, (start, size) in enumerate(pieces_of(len(tokens), length)):
                    crc = zlib.crc32(tokens[start:start + size].tobytes())
                    for column, value in zip(out, (doc, number, start, size, crc, row)):
                        column.append(value)
            return out

        return work

    rows = pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"))
    return map_slices(rows, begin, PIECE)


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, id: str = "doc_id", text: str = "text", length: int = LENGTH, places: int = OPEN_BINS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A missing or empty text is one piece of the closing id alone. Repeated rows and rows without id are packed one by
    one. Sequence ids are unique but not consecutive; offsets leave no gaps. An empty table gives no rows.
    """
    pieces = saved(token_pieces(docs, vocabulary, id, text, length), "pack-pieces")
    open_pieces = pieces.where(F.col("length") < length)
    tasks = max(1, math.ceil(open_pieces.count() / PIECES_PER_TASK))
    schema = to_arrow_schema(T.StructType.fromDDL(PACKED))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, places)
        task = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.put(size) for size in batch.column(3).to_pylist()]
            # Odd ids are packed sequences, even ones full pieces.
            sequences = pa.array([(task | bin) * 2 + 1 for bin, _ in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], sequences, pa.array([o for _, o in placed], pa.int64())], schema=schema)

    # One task's pieces in the order of a hash: the same order whenever the task is run again, and sizes well mixed.
    dealt = open_pieces.repartition(tasks, "_row").sortWithinPartitions(F.xxhash64("_row", F.lit(1)), "_row")
    full = pieces.where(F.col("length") == length).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return dealt.mapInArrow(pack, PACKED).unionByName(full)
