"""Packing into token windows online: a fixed number of open windows per partition, best fit, the fullest emitted when none fits.

Each task encodes its slice of the table and places documents as they come. A document longer than a window fills
windows of its own first. Where the rest fits in no open window and all places are taken, the fullest window is
emitted; what room it has left is filled with the head of that document. The windows left open at the end of the tasks are
merged end to end: each task's leftovers begin where those of the tasks before it end, so every task cuts its own.
The last tokens make windows whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import insort
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.llm.common import WordNumbers, Work, map_slices, pick, saved
from waymark.llm.token_counts import END, PIECES, PLAIN, byte_symbols, read_vocabulary

LENGTH = 4096
OPEN_WINDOWS = 64
END_ID = 2
MEMO_WORDS = 600_000
MEMO_TOKENS = 8_000_000
BATCH_WORDS = 4096
SLICE_BYTES = 8 << 20
# Stands behind each piece; no plain word has this character.
WORD_END = "\x01"
PIECES_AND_BLANKS = re.compile(f" |{PIECES.pattern.replace('[^', '[^ ')}")
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
# Pieces of windows left open have their ids with them, and their place among the task's leftovers.
PLACED = f"{PACKED}, task int, place long, ids binary"


class WordIds:
    """Ids of texts as the library gives them without added special tokens; words of a task are encoded once.

    Words of printable ASCII and Latin letters are split by an equal pattern and merged by tiktoken, for which a word's end is a
    byte of its own that joins the last symbol before all else; any others go to the library.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.fast = self._merger(json.loads(vocabulary))
        self.clear()

    def _merger(self, model: dict) -> Any:
        """The vocabulary for tiktoken; none unless its ids ascend with the ranks of their merges, as tiktoken takes them."""
        import tiktoken

        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        special = {t["content"] for t in model["added_tokens"]}
        own = {t: i for t, i in vocabulary.items() if t not in special}
        if [own.get("".join(pair).replace(END, "") + END * pair[1].endswith(END)) for pair in merges] != list(range(len(own) - len(merges), len(own))):
            return None
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        ranks = {}
        for token, id in own.items():
            symbols = token.removesuffix(END)
            ranks[bytes(byte_of[c] for c in symbols) + WORD_END.encode() * (token != symbols)] = id
        self.ends = np.zeros(len(own), bool)
        self.ends[[i for t, i in own.items() if t.endswith(END)]] = True
        return tiktoken.Encoding("words", pat_str=f"[^{WORD_END}]+{WORD_END}", mergeable_ranks=ranks, special_tokens={})

    def clear(self) -> None:
        self.number = WordNumbers()
        self.ids = np.empty(0, np.uint32)
        self.first = self.size = np.empty(0, np.int64)

    def _learn(self) -> None:
        """Encodes new words. The vocabulary's normaliser and splitter never join what white space parts."""
        new = [w.decode() for w in self.number.new]
        self.number.new = []
        plain = [self.fast is not None and PLAIN.fullmatch(w) is not None for w in new]
        ids, places, sizes = [self.ids], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for encode, kind in ((self._plain, True), (self._any, False)):
            own = [i for i, p in enumerate(plain) if p == kind]
            for i in range(0, len(own), BATCH_WORDS):
                words = [new[j] for j in own[i:i + BATCH_WORDS]]
                made, word = encode(words)
                ids.append(made)
                places.append(own[i:i + BATCH_WORDS])
                sizes.append(np.bincount(word, minlength=len(words)))
        size = np.concatenate(sizes)
        first = np.cumsum(size) - size + len(self.ids)
        order = np.argsort(np.concatenate(places))
        self.ids = np.concatenate(ids)
        self.first, self.size = np.append(self.first, first[order]), np.append(self.size, size[order])

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and the word of each id."""
        pieces = PIECES_AND_BLANKS.findall(" ".join(words).lower())
        blank = np.fromiter((p == " " for p in pieces), bool, len(pieces))
        ids = np.array(self.fast.encode_ordinary("".join([p + WORD_END for p in pieces if p != " "])), np.int64)
        word = np.cumsum(blank)[~blank]
        ends = self.ends[ids]
        return ids.astype(np.uint32), word[np.cumsum(ends) - ends]

    def _any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode(" ".join(words), add_special_tokens=False)
        begins = np.cumsum([0, *[len(w) + 1 for w in words]])
        return np.array(found.ids, np.uint32), np.searchsorted(begins, np.array([first for first, _ in found.offsets], np.int64), side="right") - 1

    def texts(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text; those with a special string go through the library as a whole."""
        whole = {i: t for i, t in enumerate(texts) if t and any(s in t for s in self.special)}
        words = [[] if not t or i in whole else t.split() for i, t in enumerate(texts)]
        if len(self.number) > MEMO_WORDS or len(self.ids) > MEMO_TOKENS:
            self.clear()
        find = self.number.__getitem__
        numbers = np.array([n for own in words for n in map(find, own)], np.int64)
        self._learn()
        first, size = self.first[numbers], self.size[numbers]
        ends = np.cumsum(size)
        flat = self.ids[np.repeat(first - ends + size, size) + np.arange(size.sum())]
        edges = np.concatenate([[0], ends])[np.cumsum([0, *map(len, words)])]
        made = [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        for i, text in whole.items():
            made[i] = np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        return made


class OpenWindows:
    """At most `places` open windows, kept in the order of their free space."""

    def __init__(self, length: int, places: int) -> None:
        self.length, self.places = length, places
        self.free: list[tuple[int, int]] = []  # (free space, number of the window)
        self.made = 0

    def put(self, size: int) -> list[tuple[int, int, int]]:
        """(window, offset, length) of the parts of a piece of at most a window's length, in their order."""
        parts = []
        i = self._fitting(size)
        if i is None and len(self.free) == self.places:
            # The fullest is emitted, filled up with the head of the piece.
            room, window = self.free.pop(0)
            parts.append((window, self.length - room, room))
            size -= room
            i = self._fitting(size)
        room, window = self.free.pop(i) if i is not None else (self.length, self._new())
        parts.append((window, self.length - room, size))
        if room > size:
            insort(self.free, (room - size, window))
        return parts

    def _fitting(self, size: int) -> int | None:
        """The open window with the least sufficient space."""
        low, high = 0, len(self.free)
        while low < high:
            middle = (low + high) // 2
            if self.free[middle][0] < size:
                low = middle + 1
            else:
                high = middle
        return low if low < len(self.free) else None

    def _new(self) -> int:
        self.made += 1
        return self.made - 1


def closing_lengths(total: int, length: int) -> list[int]:
    """Lengths of the windows for the tokens left at the very end: full ones, then falling powers of two."""
    rest = total % length
    return [length] * (total // length) + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def placed_documents(docs: DataFrame, vocabulary: str | None, id: str, text: str, length: int, places: int, end_id: int) -> DataFrame:
    """Pieces in emitted windows; pieces of windows left open at a task's end, in the order of their windows."""
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary, "word_bpe_49k.json"))

    def begin() -> Work:
        encoder, windows = WordIds(content.value), OpenWindows(length, places)
        task = TaskContext.get().partitionId()
        # Pieces in windows that are still open, with their ids.
        pending: dict[int, list[tuple]] = {}
        filled: dict[int, int] = {}

        def work(ids: list | None = None, texts: list | None = None) -> list:
            out: list[tuple] = []
            if ids is None:
                place = 0
                for window in sorted(pending):
                    for piece, tokens in pending[window]:
                        out.append((*piece, (task << 32 | window) * 2, None, task, place, tokens.tobytes()))
                        place += len(tokens)
                return [list(c) for c in zip(*out)] or [[]] * 10
            for doc, tokens in zip(ids, encoder.texts(texts)):
                tokens = np.append(tokens, np.array([end_id], np.uint32)).astype("<u4")
                start, size = 0, len(tokens)
                while start < size:
                    # Full windows first; a window that is filled at once never opens.
                    for window, offset, n in windows.put(min(length, size - start)) if size - start < length else [(windows._new(), 0, length)]:
                        part = tokens[start:start + n]
                        pending.setdefault(window, []).append(((doc, start, n, zlib.crc32(part.tobytes()), size), part.copy()))
                        filled[window] = filled.get(window, 0) + n
                        start += n
                        if filled[window] == length:
                            offset = 0
                            for piece, _ in pending.pop(window):
                                out.append((*piece, (task << 32 | window) * 2, offset, task, None, None))
                                offset += piece[2]
                            del filled[window]
            return [list(c) for c in zip(*out)] or [[]] * 10

        return work

    rows = pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text")
    return map_slices(rows, begin, PLACED, end=True, slice_bytes=SLICE_BYTES)


def merged_leftovers(left: DataFrame, length: int) -> DataFrame:
    """The pieces of open windows laid end to end over all tasks and cut where a window is full."""
    # One number per task.
    sizes = left.groupBy("task").agg(F.sum("length").alias("size")).toArrow().sort_by("task")
    tasks, own = sizes.column("task").to_numpy(), sizes.column("size").to_numpy()
    total = int(own.sum())
    rest = np.cumsum([0, *closing_lengths(total % length, length)]) + total // length * length
    content = left.sparkSession.sparkContext.broadcast((tasks, np.cumsum(own) - own, rest))
    schema = to_arrow_schema(T.StructType.fromDDL(PACKED))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tasks, before, rest = content.value
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at = int(before[np.searchsorted(tasks, row["task"])]) + row["place"]
                done = 0
                while done < row["length"]:
                    if at < rest[0]:
                        number, begins, ends = at // length, at // length * length, (at // length + 1) * length
                    else:
                        i = int(np.searchsorted(rest, at, side="right")) - 1
                        number, begins, ends = int(rest[0]) // length + i, int(rest[i]), int(rest[i + 1])
                    n = min(row["length"] - done, ends - at)
                    part = row["ids"][4 * done:4 * (done + n)]
                    out.append((row["doc_id"], row["start"] + done, n, zlib.crc32(part), row["doc_tokens"], number * 2 + 1, at - begins))
                    at, done = at + n, done + n
            columns = [list(c) for c in zip(*out)] or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return left.select("doc_id", "start", "length", "doc_tokens", "task", "place", "ids").mapInArrow(cut, PACKED)


def pack_windows(
    docs: DataFrame, vocabulary: str | None = None, id: str = "doc_id", text: str = "text",
    length: int = LENGTH, places: int = OPEN_WINDOWS, end_id: int = END_ID,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece; no window needs padding.

    A window holds `length` tokens or, at most once for each power of two, fewer. A missing or empty text is the closing id alone.
    Repeated rows and rows without id are packed one by one. Sequence ids are unique but not consecutive: even ones were
    emitted by a task, odd ones merged. An empty table gives no rows.
    """
    placed = saved(placed_documents(docs, vocabulary, id, text, length, places, end_id), "packed-windows")
    emitted = placed.where(F.col("place").isNull()).select(*[f.name for f in T.StructType.fromDDL(PACKED)])
    return emitted.unionByName(merged_leftovers(placed.where(F.col("place").isNotNull()), length))
