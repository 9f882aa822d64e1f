"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and how often their ids end together.

The coarse cuts are the libraries' own spans: character offsets of `tokenizers` and the byte offsets of
sentencepiece. Where a token ends inside a character (byte-level tokens, byte fallback) the spans of its neighbours share the
character, and the cuts are refined with the bytes that the tokens decode to. Both tokenizers cut at a single blank between
two words, so texts are taken apart there and equal words of a task are encoded once.

A frequent pair of ids occurs in a third of the texts. A fixed number of the most frequent pairs is therefore sent to
all tasks; only the rare ones are joined.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.llm.common import WordNumbers, Work, map_slices, pick, saved
from waymark.llm.token_counts import byte_symbols, read_vocabulary

BATCH_WORDS = 4096
BATCH_CHARACTERS = 1 << 16
# Words and groups that a task remembers; past either it begins anew.
MEMO_WORDS = 600_000
MEMO_GROUPS = 4_000_000
HEAD_PAIRS = 1 << 16
BATCH_ROWS = 2048
# Ids of either vocabulary have at most so many bits.
ID_BITS = 20
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# A blank beside white space; patterns that begin with a plain character are searched for fast.
UNEVEN = re.compile(r" (?:(?<=\s )|(?=\s))")

ALIGNED = "doc_id long, _row long, n_a long, n_b long, n_groups long, groups string, a_ids array<int>, b_ids array<int>, times array<int>"
LINKED = (
    "doc_id long, _row long, n_a long, n_b long, n_groups long, groups string, "
    "head_best long, head_sum long, rare_pairs array<long>, rare_times array<long>"
)
SPANS = "doc_id long, groups array<struct<first:int,past:int,a_ids:array<int>,b_ids:array<int>>>"


def read_model(path: str | None, default: str) -> bytes:
    """The content of a sentencepiece model (about 0.5 MB); read once, on the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(default)
    with open(path, "rb") as file:
        return file.read()


def refined(coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from their spans' ends and decoded lengths.

    A span as wide as its token's bytes is right. In a run of others the spans share characters: there the decoded lengths count on
    from the last right end.
    """
    wrong = np.diff(coarse, prepend=0) != sizes
    if not wrong.any():
        return coarse
    total = np.cumsum(sizes)
    begins = np.flatnonzero(wrong & ~np.concatenate([[False], wrong[:-1]]))
    run = begins[np.searchsorted(begins, np.flatnonzero(wrong), side="right") - 1]
    before = np.concatenate([[0], coarse])[run] - np.concatenate([[0], total])[run]
    ends = coarse.copy()
    ends[wrong] = total[wrong] + before
    return ends


def byte_lengths(text: str) -> np.ndarray:
    """UTF-8 bytes of each character."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64)


class Tokenizers:
    """Ids and byte ends by both tokenizers: A of a blank and the text, B of the text, which adds the blank itself."""

    def __init__(self, a: str, b: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        model = json.loads(a)
        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, id in model["model"]["vocab"].items():
            self.a_bytes[id] = bytes(byte_of[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS:
            raise ValueError(f"a vocabulary has more than {1 << ID_BITS} ids")
        self.a_lengths, self.b_lengths = (np.array(list(map(len, v)), np.int64) for v in (self.a_bytes, self.b_bytes))
        # A parts words before a blank by its pattern; B does where no piece goes on behind a blank and texts stay as they are.
        split = model["pre_tokenizer"] or {}
        self.by_word = (
            model["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space", True) and not any("▁" in p.lstrip("▁") for p in pieces)
            and self.b.normalize(" a\xa0 ﬁ  É ") == "▁▁a\xa0▁ﬁ▁▁É▁"
        )

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """A's ids and ends, B's ids and ends, over the bytes of a blank and the text; none where decoded bytes differ from these."""
        whole = f" {text}"
        found = self.a.encode(whole, add_special_tokens=False)
        a_ids = np.array(found.ids, np.int64)
        a_ends = np.array([end for _, end in found.offsets], np.int64)
        if not whole.isascii():
            a_ends = np.concatenate([[0], np.cumsum(byte_lengths(whole))])[a_ends]
        spans = self.b.encode(text.encode(), return_type="offset_mapping")
        b_ids = np.array(spans["ids"], np.int64)
        b_ends = np.array([end for _, end in spans["offsets"]], np.int64)
        bytes_ = whole.encode()
        if b"".join([self.a_bytes[i] for i in a_ids.tolist()]) != bytes_ or b"".join([self.b_bytes[i] for i in b_ids.tolist()]) != bytes_:
            return None
        # B's spans count from the text's first byte, behind the added blank.
        return a_ids, refined(a_ends, self.a_lengths[a_ids]), b_ids, refined(b_ends + 1, self.b_lengths[b_ids])

    def words(self, text: str) -> list[str]:
        """Parts of the text between which both tokenizers always cut, each without the blank before it."""
        if not self.by_word:
            return [text]
        uneven = text[:1] == " " or text[-1:] == " " or UNEVEN.search(text)
        return BETWEEN.split(text) if uneven else text.split(" ")


def grouped(tokens: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where tokens of both end together, and each such group's number of A and of B tokens."""
    _, a_ends, _, b_ends = tokens
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_sizes, b_sizes = (np.diff(np.searchsorted(ends, shared, side="right"), prepend=0) for ends in (a_ends, b_ends))
    return shared, a_sizes, b_sizes


@cache
def marked(bits: int) -> list[str]:
    """Every id of so many bits with each of the four marks behind it."""
    return [f"{i}{mark}" for i in range(1 << bits) for mark in ",|;#"]


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, last: np.ndarray) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` for each word; `last` are the groups that end one."""
    group = np.repeat(np.arange(len(a_sizes)), a_sizes), np.repeat(np.arange(len(b_sizes)), b_sizes)
    a_past, b_past = np.cumsum(a_sizes), np.cumsum(b_sizes)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    marks = np.zeros(len(ids), np.int64)
    # Before an A token stand the B tokens of earlier groups, before a B token also the A tokens of its own group.
    ids[np.arange(len(a_ids)) + (b_past - b_sizes)[group[0]]] = a_ids
    ids[np.arange(len(b_ids)) + a_past[group[1]]] = b_ids
    marks[a_past + b_past - b_sizes - 1] = 1
    marks[a_past + b_past - 1] = 2
    marks[(a_past + b_past - 1)[last]] = 3
    written = marked(int(ids.max()).bit_length())
    return "".join(map(written.__getitem__, (ids << 2 | marks).tolist())).split("#")[:-1]


class Memo:
    """Groups of the words seen so far, in flat arrays; a word whose bytes cannot be had back has none."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number = WordNumbers()
        self.texts: list[str] = []
        self.pairs = np.empty(0, np.int64)
        # Each word's A tokens, B tokens and groups, and where its groups begin.
        self.size, self.first = np.empty((3, 0), np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Encodes the words that are new, many together between blanks."""
        new, self.number.new = self.number.new, []
        found: list[tuple[Sequence[int], np.ndarray, list[str], np.ndarray]] = []
        # A word at the edge of a text may have white space at its own edge; it cannot stand between others.
        alone = [place for place, word in enumerate(new) if not word or word.strip() != word]
        for place in alone:
            found.extend(self._encoded([new[place]], [place]))
        places = range(len(new))
        if alone:
            apart = set(alone)
            places = [place for place in places if place not in apart]
            new = [new[place] for place in places]
        ends = np.cumsum(list(map(len, new)))
        start = 0
        while start < len(new):
            before = ends[start - 1] if start else 0
            stop = min(int(np.searchsorted(ends, before + BATCH_CHARACTERS)) + 1, start + BATCH_WORDS)
            found.extend(self._encoded(new[start:stop], places[start:stop]))
            start = stop
        if not found:
            return
        order = np.argsort(np.concatenate([places for places, _, _, _ in found]))
        sizes = np.concatenate([s for _, s, _, _ in found], axis=1)
        self.first = np.append(self.first, (len(self.pairs) + np.cumsum(sizes[2]) - sizes[2])[order])
        self.size = np.concatenate([self.size, sizes[:, order]], axis=1)
        self.pairs = np.concatenate([self.pairs, *[p for _, _, _, p in found]])
        texts = [t for _, _, own, _ in found for t in own]
        self.texts += [texts[i] for i in order.tolist()]

    def _encoded(self, words: list[str], places: Sequence[int]) -> Iterator[tuple[Sequence[int], np.ndarray, list[str], np.ndarray]]:
        """The words' places, their sizes (A tokens, B tokens, groups), texts, and the two tokens that end each group as one number."""
        made = self.tokenizers.encode(" ".join(words)) if words != [""] else None
        if made is not None:
            a_ids, a_ends, b_ids, b_ends = made
            shared, a_sizes, b_sizes = grouped(made)
            borders = np.cumsum([len(w.encode()) + 1 for w in words])
            last = np.searchsorted(shared, borders)
            if last[-1] < len(shared) and (shared[last] == borders).all():
                sizes = np.array([np.diff(np.searchsorted(e, borders, side="right"), prepend=0) for e in (a_ends, b_ends, shared)])
                pairs = a_ids[np.cumsum(a_sizes) - 1] << ID_BITS | b_ids[np.cumsum(b_sizes) - 1]
                yield places, sizes, group_texts(a_ids, b_ids, a_sizes, b_sizes, last), pairs
                return
        if len(words) == 1:
            yield places, np.zeros((3, 1), np.int64), [""], np.empty(0, np.int64)
            return
        for word, place in zip(words, places):
            yield from self._encoded([word], [place])

    def gather(self, texts: Sequence[list[str]]) -> tuple[np.ndarray, list[str], list[np.ndarray]]:
        """Of texts as lists of words: sizes (A tokens, B tokens, groups), the groups' texts, and the different pairs of all texts in a
        row with how often each is in its text and where each text begins."""
        if len(self.number) > MEMO_WORDS or len(self.pairs) > MEMO_GROUPS:
            self.clear()
        find = self.number.__getitem__
        numbers = [list(map(find, words)) for words in texts]
        self._learn()
        flat = np.fromiter(chain.from_iterable(numbers), np.int64, sum(map(len, numbers)))
        text = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
        # One word whose bytes cannot be had back leaves its text without tokens.
        spoilt = np.zeros(len(texts), bool)
        spoilt[text[self.size[2][flat] == 0]] = True
        flat, text = flat[~spoilt[text]], text[~spoilt[text]]
        own = self.size[:, flat]
        sizes = np.array([np.bincount(text, weights=s, minlength=len(texts)) for s in own]).astype(np.int64)
        groups = ["" if bad else ";".join(map(self.texts.__getitem__, own)) for bad, own in zip(spoilt.tolist(), numbers)]
        ends = np.cumsum(own[2])
        pairs = self.pairs[np.repeat(self.first[flat] - ends + own[2], own[2]) + np.arange(own[2].sum())]
        keys = np.sort(np.repeat(text, own[2]) << 2 * ID_BITS | pairs)
        begins = np.flatnonzero(np.diff(keys, prepend=-1))
        bounds = np.searchsorted(keys[begins] >> 2 * ID_BITS, np.arange(len(texts) + 1))
        return sizes, groups, [keys[begins] & (1 << 2 * ID_BITS) - 1, np.diff(np.append(begins, len(keys))), bounds]


def lists(values: np.ndarray, bounds: np.ndarray, kind: T.DataType) -> pa.ListArray:
    """Values of all rows in a row as one list per row."""
    arrow = to_arrow_schema(T.StructType([T.StructField("v", T.ArrayType(kind))])).field(0).type
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, arrow.value_type), type=arrow)


def _tokenizers(docs: DataFrame, a: str | None, b: str | None) -> Callable[[], Tokenizers]:
    content = docs.sparkSession.sparkContext.broadcast((read_vocabulary(a, "byte_bpe_50k.json"), read_model(b, "piece_bpe_32k.model")))
    return lambda: Tokenizers(*content.value)


def aligned_spans(docs: DataFrame, a: str | None = None, b: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and groups (first and past byte in a blank and the text, A ids, B ids) of every row; map-only.

    Rows without tokens, as in `align_tokenizers`, have no groups.
    """
    make = _tokenizers(docs, a, b)

    def begin() -> Work:
        tokenizers = make()

        def groups(text: bytes | None) -> list[dict]:
            made = tokenizers.encode(text.decode()) if text else None
            if made is None:
                return []
            shared, a_sizes, b_sizes = grouped(made)
            own = (np.split(ids, np.cumsum(sizes)[:-1]) for ids, sizes in ((made[0], a_sizes), (made[2], b_sizes)))
            edges = zip([0, *shared.tolist()], shared.tolist(), *own)
            return [{"first": f, "past": p, "a_ids": x.tolist(), "b_ids": y.tolist()} for f, p, x, y in edges]

        return lambda ids, texts: [ids, list(map(groups, texts))]

    return map_slices(pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text"), begin, SPANS)


def aligned_documents(
    docs: DataFrame, a: str | None, b: str | None, id: str, text: str, groups: Callable[[str], str],
) -> DataFrame:
    """Tokens, groups and the different pairs of ids that end a group, of every row; `_row` holds for one reading, so save it."""
    make = _tokenizers(docs, a, b)

    def begin() -> Work:
        tokenizers = make()
        memo = Memo(tokenizers)

        def work(ids: list, texts: list[bytes | None], rows: list[int]) -> list:
            sizes, made, (pairs, times, bounds) = memo.gather([tokenizers.words(t.decode()) if t else [] for t in texts])
            columns = [lists(v, bounds, T.IntegerType()) for v in (pairs >> ID_BITS, pairs & (1 << ID_BITS) - 1, times)]
            return [ids, rows, *sizes, list(map(groups, made)), *columns]

        return work

    rows = pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"))
    return map_slices(rows, begin, ALIGNED, slice_rows=BATCH_ROWS)


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and their times of all rows in a row, and where each row begins."""
    a_ids, b_ids, times = (np.asarray(batch.column(n).flatten(), np.int64) for n in ("a_ids", "b_ids", "times"))
    bounds = np.asarray(batch.column("times").offsets, np.int64)
    return a_ids << ID_BITS | b_ids, times, bounds - bounds[0]


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair (A id in the upper bits, B id in the lower ID_BITS), n (its links over all texts), best (none with that B id has more)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, _ = _pairs(batch)
            order = np.argsort(pairs)
            begins = np.flatnonzero(np.diff(pairs[order], prepend=-1))
            n = np.add.reduceat(times[order], begins) if len(begins) else times
            yield pa.RecordBatch.from_arrays([pa.array(pairs[order][begins], pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    counted = aligned.select("a_ids", "b_ids", "times").mapInArrow(count, "pair long, n long")
    counts = saved(counted.groupBy("pair").agg(F.sum("n").alias("n")), "link-counts")
    b_id = F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    # One row per id of B's vocabulary.
    most = counts.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(F.broadcast(most), b_id == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def linked_documents(aligned: DataFrame, counts: DataFrame, head: int = HEAD_PAIRS) -> DataFrame:
    """The rows of a saved table of aligned documents with n_best and count_sum; `head` pairs go to all tasks."""
    top = counts.orderBy(F.desc("n"), "pair").limit(head).orderBy("pair").toArrow()
    content = aligned.sparkSession.sparkContext.broadcast([
        np.append(top.column("pair").to_numpy(), -1), np.append(top.column("n").to_numpy(), 0), np.append(top.column("best").to_numpy(), False),
    ])
    schema = to_arrow_schema(T.StructType.fromDDL(LINKED))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counted, best = content.value
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                pairs, times, bounds = _pairs(batch)
                place = np.searchsorted(known[:-1], pairs)
                rare = known[place] != pairs
                place[rare] = len(known) - 1
                sums = [np.diff(np.concatenate([[0], np.cumsum(v[place] * times)])[bounds]) for v in (best, counted)]
                own = np.concatenate([[0], np.cumsum(rare)])[bounds]
                rests = [lists(v[rare], own, T.LongType()) for v in (pairs, times)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], *[pa.array(s, pa.int64()) for s in sums], *rests], schema=schema)

    linked = saved(aligned.mapInArrow(link, LINKED), "linked")
    rare = linked.select("_row", F.explode(F.arrays_zip("rare_pairs", "rare_times")).alias("_rare"))
    rare = rare.select("_row", F.col("_rare.rare_pairs").alias("pair"), F.col("_rare.rare_times").alias("_times")).join(counts, "pair")
    rests = rare.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("_times")).alias("_sum"),
    )
    # A group ends with one token of each, which is its link.
    return linked.join(rests, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), (F.col("head_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("head_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups",
    )


def align_tokenizers(
    docs: DataFrame, a: str | None = None, b: str | None = None, id: str = "doc_id", text: str = "text",
    groups: Callable[[str], str] = str, head: int = HEAD_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row.

    A group ends where tokens of both end; its text is `a1,a2|b1`, groups are parted by `;`, and `groups` may make something shorter of
    a row's text. A link is the A and the B token that end a group; n_best counts the links whose pair of ids is its B id's
    most frequent one in all texts, count_sum adds up the pairs' counts. `a` is the path of a byte-level byte-pair file
    (.json), `b` of a sentencepiece model. Rows without tokens (missing or empty texts, texts whose bytes the tokens do not give back)
    have zeros; repeated rows count each time; a missing id stays missing; an empty table gives no rows.
    """
    aligned = saved(aligned_documents(docs, a, b, id, text, groups), "aligned")
    counts = saved(link_counts(aligned), "link-pairs")
    return linked_documents(aligned, counts, head)


def text_digest(text: str) -> str:
    """Hexadecimal sha256 of the text, of none an empty string."""
    return hashlib.sha256(text.encode()).hexdigest() if text else ""
