"""Token counts by byte-pair merging: a heap of adjacent pairs over a linked list; the count is initial symbols minus merges.

No token identifiers are made. A document's count is the sum over its words, and each word is merged once per task
(the memo is bounded and only saves work). Normalisation and the split into pieces follow the vocabulary file; words
of plain ASCII and Latin-1 letters are split by an equal pattern here, all others by the file's own normaliser and
splitter in the library.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from waymark.llm.common import Work, map_slices, pick

MEMO_WORDS = 400_000
LIMIT = 2048
END = "</w>"
# Words whose normalised pieces the pattern below gives: printable ASCII and composed Latin-1 letters.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The split of the vocabulary file, narrowed to PLAIN.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next one from 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    shown = set(own)
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def merges_of(symbols: Sequence[str], ranks: dict[tuple[str, str], int]) -> int:
    """How often two adjacent symbols merge when the lowest rank, leftmost first, always goes next."""
    parts: list[str | None] = list(symbols)
    size = len(parts)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = [(rank, i) for i in range(size - 1) if (rank := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    done = 0
    while heap:
        rank, left = heapq.heappop(heap)
        right = after[left]
        # The pair may be gone, or one side may have grown since.
        if parts[left] is None or right >= size or ranks.get((parts[left], parts[right])) != rank:
            continue
        parts[left] += parts[right]
        parts[right] = None
        done += 1
        beyond = after[left] = after[right]
        if beyond < size:
            before[beyond] = left
            if (rank := ranks.get((parts[left], parts[beyond]))) is not None:
                heapq.heappush(heap, (rank, left))
        earlier = before[left]
        if earlier >= 0 and (rank := ranks.get((parts[earlier], parts[left]))) is not None:
            heapq.heappush(heap, (rank, earlier))
    return done


class WordCounts(dict):
    """Tokens of a word between white space, kept for words seen before."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        model = json.loads(vocabulary)
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["model"]["merges"])}
        self.special = [t["content"] for t in model["added_tokens"]]
        self.cut = re.compile("|".join(map(re.escape, self.special)).encode()) if self.special else None
        library = Tokenizer.from_str(vocabulary)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.symbols = byte_symbols()
        self.pieces: dict[str, int] = {}

    def __missing__(self, word: bytes) -> int:
        text = word.decode()
        if PLAIN.fullmatch(text):
            symbols = self.symbols
            pieces = ["".join([symbols[b] for b in p.encode()]) for p in PIECES.findall(text.lower())]
        else:
            pieces = [piece for piece, _ in self.split(self.normalise(text))]
        count = sum(map(self.piece, pieces))
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = count
        return count

    def piece(self, piece: str) -> int:
        """Initial symbols minus merges; the last symbol carries the word's end."""
        count = self.pieces.get(piece)
        if count is None:
            count = len(piece) - merges_of([*piece[:-1], piece[-1] + END], self.ranks)
            if len(self.pieces) >= MEMO_WORDS:
                self.pieces.clear()
            self.pieces[piece] = count
        return count

    def text(self, text: bytes | None) -> int:
        """Special strings inside a text are one token each and part it; the rest is words."""
        if not text:
            return 0
        if self.cut is None or b"<|" not in text:
            return sum(map(self.__getitem__, text.split()))
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, part.split())) for part in parts)


def read_vocabulary(path: str | None, default: str) -> str:
    """The vocabulary file's text; read once, on the driver (about 2 MB)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(default)
    with open(os.fspath(path), encoding="utf-8") as file:
        return file.read()


def token_counts(docs: DataFrame, vocabulary: str | None = None, id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, as the library counts them without added special tokens.

    Map-only. Missing and empty texts have no bytes and no tokens; a missing id stays missing; repeated rows give
    equal rows. `vocabulary` is the path of a word-end byte-pair file (.json).
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary, "word_bpe_49k.json"))

    def begin() -> Work:
        counts = WordCounts(content.value)

        def work(ids: list, texts: list[bytes | None]) -> list:
            tokens = [counts.text(t) for t in texts]
            return [ids, [len(t or b"") for t in texts], tokens, [n > limit for n in tokens]]

        return work

    return map_slices(pick(docs, doc_id=id, text=text).selectExpr("cast(doc_id as long) doc_id", "text"), begin,
                      "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
