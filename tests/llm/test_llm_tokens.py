from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waymark.llm import packing, token_counts as counts
from waymark.llm.packing import OpenBins, pack_documents, pieces_of
from waymark.llm.queries import op8_token_counts, op10_packing
from waymark.llm.token_counts import WordCounts, merges_of, read_vocabulary, token_counts

TEXTS = [
    "Σίσυφος ΣΑΣ İstanbul", "<|endoftext|> a <|startoftext|>x <|endoftext|", "a  b\n c   d \n \n e", "é é ½ ２３ ²", "👍🏽 it's I'LL 'S",
    "ﬁ \x1c z\x85y q", " lead", "trail ", "\n\n", "x" * 3000, "don't!!! ###", "l'été à Noël", "a b", "日本語のテキスト",
]


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def odd(spark, both):
    rows = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return both.select("doc_id", "text").unionByName(rows)


def counted(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())


def want_counts(rows, library):
    sizes = [len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows]
    return Counter((r["doc_id"], len((r["text"] or "").encode()), n, n > 2048) for r, n in zip(rows, sizes))


def test_counts_equal_the_library(spark, sf, documents, odd, word_library):
    assert counted(op8_token_counts(spark, sf)) == want_counts(documents.collect(), word_library)
    assert counted(token_counts(odd)) == want_counts(odd.collect(), word_library)


def test_bounded_memo(spark, odd, word_library, monkeypatch):
    monkeypatch.setattr(counts, "MEMO_WORDS", 2)
    small = odd.limit(40)
    assert counted(token_counts(small)) == want_counts(small.collect(), word_library)


def test_no_rows(empty):
    assert token_counts(empty).collect() == [] and pack_documents(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8", exclude_categories=("Cn", "Cs", "Co")), max_size=40))
def test_any_text_counts_like_the_library(text):
    library, own = any_text()
    assert own.text(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


_any: list = []


def any_text():
    if not _any:
        content = read_vocabulary(None, "word_bpe_49k.json")
        _any.extend([Tokenizer.from_str(content), WordCounts(content)])
    return _any


def test_merges_take_the_lowest_rank_first():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("a", "a"): 3}
    assert merges_of("abc", ranks) == 2
    assert merges_of("ab", ranks) == 1
    assert merges_of("aaaaa", ranks) == 2
    assert merges_of("", ranks) == merges_of("z", ranks) == 0


def want_pieces(rows, library, length):
    want = Counter()
    for r in rows:
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        sizes = [len(ids) % length or length] + [length] * ((len(ids) - 1) // length)
        for piece, size in enumerate(sizes):
            want[r["doc_id"], piece, start, size, zlib.crc32(ids[start:start + size].tobytes())] += 1
            start += size
        assert start == len(ids)
    return want


def check_packed(rows, want, length):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        end = 0
        for offset, size in sorted(own):
            assert offset == end
            end += size
        assert end <= length
    return len(places)


def test_packing_query(spark, sf, documents, byte_library):
    rows = op10_packing(spark, sf).collect()
    want = want_pieces(documents.collect(), byte_library, 2048)
    used = check_packed(rows, want, 2048)
    assert used <= 1.1 * sum(r["length"] for r in rows) / 2048 + 1


def test_packing_odd_rows_in_many_tasks(odd, byte_library, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 40)
    rows = pack_documents(odd, length=64, places=5).collect()
    check_packed(rows, want_pieces(odd.collect(), byte_library, 64), 64)


@pytest.mark.parametrize("size", [1, 63, 64, 65, 128, 129])
def test_only_the_first_piece_is_shorter(size):
    pieces = pieces_of(size, 64)
    assert sum(n for _, n in pieces) == size and all(n == 64 for _, n in pieces[1:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200), st.integers(1, 6))
def test_bins_against_a_plain_search(sizes, places):
    bins = OpenBins(32, places)
    free: dict[int, int] = {}
    for size in sizes:
        bin, offset = bins.put(size)
        fitting = [space for space in free.values() if space >= size]
        if fitting:
            assert free[bin] == min(fitting)
        else:
            assert bin not in free
            if len(free) == places:
                fullest = min(free.values())
                # Which of several equally full bins closes does not matter.
                del free[next(b for b in free if free[b] == fullest and b not in {x for own in bins.bins.values() for x in own})]
            free[bin] = 32
        assert offset == 32 - free[bin]
        free[bin] -= size
        if not free[bin]:
            del free[bin]
        assert len(free) == bins.count <= places
        assert bins.free == sum({1 << space for space in free.values()})
