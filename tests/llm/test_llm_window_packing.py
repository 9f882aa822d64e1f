from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waymark.llm import window_packing
from waymark.llm.queries import op12_window_packing
from waymark.llm.token_counts import read_vocabulary
from waymark.llm.window_packing import OpenWindows, WordIds, closing_lengths, pack_windows

TEXTS = [
    "Σίσυφος ΣΑΣ İstanbul", "<|endoftext|> a <|startoftext|>x <|endoftext|", "a  b\n c   d \n \n e", "é é ½ ２３ ²", "👍🏽 it's I'LL 'S",
    "ﬁ \x1c z\x85y q", " lead", "trail ", "\n\n", "x" * 3000, "don't!!! ###", "l'été à Noël", "日本語のテキスト", "e ́ à", "\x00 a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def odd(spark, edge):
    rows = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return edge.select("doc_id", "text").unionByName(rows)


def padding(size, length):
    return 0 if size & (size - 1) == 0 else length - size


def check(found, rows, library, length, end_id=2):
    """Every id of every document lies in one piece, windows have no gaps; returns (windows, padding)."""
    docs = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids) + (end_id,)) for r in rows)
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    sizes = Counter()
    for (doc, ids), n in docs.items():
        sizes[doc, len(ids)] += n * len(ids)
    assert sizes == Counter({key: sum(r["length"] for r in own) for key, own in by_doc.items()})
    for (doc, n_ids), own in by_doc.items():
        texts = [ids for (d, ids), n in docs.items() if d == doc and len(ids) == n_ids for _ in range(n)]
        # The pieces of each copy: from every place on where a piece ends another begins.
        starts = Counter(r["start"] for r in own)
        ends = Counter(r["start"] + r["length"] for r in own)
        assert starts - ends == Counter({0: len(texts)}) and ends - starts == Counter({n_ids: len(texts)})
        crcs = {r: {zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for ids in texts} for r in own}
        assert all(r["ids_crc32"] in crcs[r] for r in own)
    windows = defaultdict(list)
    for r in found:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    lost = 0
    for own in windows.values():
        end = 0
        for offset, size in sorted(own):
            assert offset == end and size > 0
            end += size
        assert end <= length
        lost += padding(end, length)
    return len(windows), lost


def test_query(spark, sf, documents, library):
    found = op12_window_packing(spark, sf).collect()
    windows, lost = check(found, documents.collect(), library, 4096)
    tokens = sum(r["length"] for r in found)
    assert lost == 0 and windows <= tokens // 4096 + 12
    whole = Counter((r["doc_id"], r["start"], r["length"] == r["doc_tokens"]) for r in found)
    assert sum(n for (_, start, all_), n in whole.items() if start == 0 and all_) > 0.5 * documents.count()


@pytest.mark.parametrize("length, places, parts", [(64, 5, 7), (8, 1, 3), (4096, 64, 1), (64, 3, 40)])
def test_odd_rows_in_many_tasks(odd, library, length, places, parts):
    found = pack_windows(odd.repartition(parts), length=length, places=places).collect()
    assert check(found, odd.collect(), library, length)[1] == 0


def test_clashing_columns_and_no_rows(edge, empty, library):
    assert check(pack_windows(edge).collect(), edge.select("doc_id", "text").collect(), library, 4096)[1] == 0
    assert pack_windows(empty).collect() == []


def test_small_memo(odd, library, monkeypatch):
    monkeypatch.setattr(window_packing, "MEMO_WORDS", 3)
    encoder = WordIds(read_vocabulary(None, "word_bpe_49k.json"))
    texts = [r["text"] for r in odd.select("text").collect()]
    for slice in (texts[:9], texts[9:], texts):
        made = encoder.texts([None if t is None else t.encode() for t in slice])
        assert [m.tolist() for m in made] == [library.encode(t or "", add_special_tokens=False).ids for t in slice]


_own: list = []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=("Cn", "Cs", "Co")), max_size=30), max_size=4))
def test_any_text_like_the_library(texts):
    if not _own:
        content = read_vocabulary(None, "word_bpe_49k.json")
        _own.extend([Tokenizer.from_str(content), WordIds(content)])
    made = _own[1].texts([t.encode() for t in texts])
    assert [m.tolist() for m in made] == [_own[0].encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=200), st.integers(1, 6))
def test_windows_against_a_plain_search(sizes, places):
    windows = OpenWindows(32, places)
    free: dict[int, int] = {}
    for size in sizes:
        parts = windows.put(size)
        assert sum(n for _, _, n in parts) == size
        if not any(room >= size for room in free.values()) and len(free) == places:
            fullest = min(free.values())
            window, offset, n = parts.pop(0)
            assert free.pop(window) == fullest == n and offset == 32 - fullest
            size -= n
        ((window, offset, n),) = parts
        fitting = [room for room in free.values() if room >= size]
        assert free.get(window) == (min(fitting) if fitting else None)
        room = free.pop(window, 32)
        assert n == size and offset == 32 - room
        if room > size:
            free[window] = room - size
        assert len(free) <= places and sorted((r, w) for w, r in free.items()) == windows.free


def test_a_vocabulary_whose_ids_do_not_follow_its_merges(library):
    model = json.loads(read_vocabulary(None, "word_bpe_49k.json"))
    vocabulary = model["model"]["vocab"]
    one, other = (next(t for t, i in vocabulary.items() if i == n) for n in (600, 601))
    vocabulary[one], vocabulary[other] = 601, 600
    encoder = WordIds(json.dumps(model))
    moved = Tokenizer.from_str(json.dumps(model))
    assert encoder.fast is None
    assert [m.tolist() for m in encoder.texts([t.encode() for t in TEXTS])] == [moved.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_closing_lengths():
    assert closing_lengths(0, 64) == [] and closing_lengths(64, 64) == [64] and closing_lengths(64 + 37, 64) == [64, 32, 4, 1]
