from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymark.llm.decontamination import FMIndex, WaveletMatrix, find_benchmark, items_digest, suffix_order
from waymark.llm.queries import op6_decontamination

ITEMS = [
    (9001, "the CAT sat"), (9001, "on the mat"), (9002, None), (9003, ""), (None, "le chat et"), (9004, "zzqq"), (9005, "日本語"),
    (9006, "the cat and the dog the cat and the dog the cat and the dog the"),
]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def by_windows(rows, items, size=13):
    owners = defaultdict(set)
    for item, text in items:
        own = words(text)
        for start in range(max(1, len(own) - size + 1)) if own else ():
            owners[tuple(own[start:start + size])].add(item)
    lengths = {len(w) for w in owners}
    want = Counter()
    for doc, text in rows:
        own = words(text)
        hit, found = [False] * len(own), set()
        for length in lengths:
            for start in range(len(own) - length + 1):
                if window := owners.get(tuple(own[start:start + length])):
                    found |= window
                    hit[start:start + length] = [True] * length
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        want[doc, len(own), sum(hit), len(names), digest, any(hit) and 20 * sum(hit) >= len(own)] += 1
    return want


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


def test_query_agrees_with_all_windows(spark, sf, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = by_windows([(r["doc_id"], r["text"]) for r in documents.collect()], items)
    assert got(op6_decontamination(spark, sf)) == want
    assert any(row[-1] for row in want)


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_short_items_missing_values_and_blocks(spark, both, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_benchmark(both, items, block_bytes=block_bytes, keep=True)
    want = by_windows([(r["doc_id"], r["text"]) for r in both.collect()], ITEMS)
    assert got(found.select("*", *items_digest())) == want
    assert found.select("_doc.*").columns == both.columns
    # Spans are apart from each other and cover just the hit words.
    for row in found.select("spans", "n_hit").collect():
        edges = [edge for span in row["spans"] for edge in span]
        assert edges == sorted(set(edges)) and sum(p - f for f, p in row["spans"]) == row["n_hit"]


def test_no_rows(spark, empty, edge):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_benchmark(empty, items).collect() == []
    assert not any(r["contaminated"] for r in find_benchmark(edge, items.where("false")).collect())


def runs_text(seed, size, symbols):
    text = np.random.default_rng(seed).integers(0, symbols + 1, size)
    text[-1] = 0
    return text


@pytest.mark.parametrize(("seed", "symbols"), [(0, 2), (1, 5), (2, 300)])
def test_index_finds_every_occurrence(seed, symbols):
    text = runs_text(seed, 2000, symbols)
    index = FMIndex(text, symbols)
    for length in (1, 2, 5):
        windows = np.unique(np.random.default_rng(seed).integers(1, symbols + 1, (50, length)), axis=0)
        found = {int(w): (int(a), int(b)) for w, a, b in zip(*index.search(windows))}
        for number, window in enumerate(windows):
            places = [i for i in range(len(text) - length + 1) if (text[i:i + length] == window).all()]
            low, high = found.get(number, (0, 0))
            assert sorted(index.locate(np.arange(low, high)).tolist()) == places


def test_suffix_order_and_ranks():
    text = np.array([1, 2, 1, 2, 1, 0, 1, 2, 0])
    keys = [tuple((0, i + j) if s == 0 else (1, s) for j, s in enumerate(text[i:])) for i in range(len(text))]
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: [(a, b) for a, b in keys[i]])
    ranks = WaveletMatrix(text, 2)
    for symbol in range(3):
        places = np.arange(len(text) + 1)
        assert ranks.rank(np.full(len(places), symbol), places).tolist() == [int((text[:p] == symbol).sum()) for p in places]
