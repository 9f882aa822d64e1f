"""The Jaccard join against all pairs, and connected components against union-find."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from waymark.llm import ngram_join
from waymark.llm.components import components
from waymark.llm.ngram_join import Shingles, choose_k, cross_pairs, most_shared, needed, similar_groups
from waymark.llm.queries import op1_ngram_join


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def roots_of(count, links):
    root = list(range(count))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(a) for a in range(count)]


def by_all_pairs(rows, size, percent):
    sets = [shingle_set(text, size) for _, text in rows]
    links = [
        (a, b) for a, b in combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    members = defaultdict(list)
    roots = roots_of(len(rows), links)
    for row, root in enumerate(roots):
        members[root].append(rows[row][0])
    return Counter(
        (rows[row][0], len(sets[row]), min((i for i in members[root] if i is not None), default=None))
        for row, root in enumerate(roots)
    )


def got(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def near_copies(count, words, changes, seed=0):
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for number in range(count):
        own = list(base)
        for _ in range(draw.randint(0, changes)):
            own[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
        out.append((10_000 + number, " ".join(own)))
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 100), (2, 50)])
def test_groups_agree_with_all_pairs(spark, both, size, percent):
    rows = [(r["doc_id"], r["text"]) for r in both.collect()] + near_copies(60, 120, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(similar_groups(docs, size, percent)) == by_all_pairs(rows, size, percent)


def test_hot_lists_and_many_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LIST", 3)
    monkeypatch.setattr(ngram_join, "POSTINGS_PER_BUCKET", 10)
    rows = near_copies(80, 60, 3) + near_copies(20, 60, 40, seed=1)
    assert got(similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80)) == by_all_pairs(rows, 3, 80)


def test_chain_of_near_copies_is_one_group(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[:100 - i] + [f"y{j}" for j in range(i)])) for i in range(12)]
    found = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert got(found) == by_all_pairs(rows, 3, 90)


def edited_chains(seed, chains=6, steps=8, words=120):
    """Copies of copies: each chain starts from one text, and each step changes a few words of the one before."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for _ in range(chains):
        own = list(base)
        for _ in range(steps):
            for _ in range(draw.randint(1, 4)):
                own[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
            rows.append((draw.randrange(10**6), " ".join(own)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_chains_that_meet_in_lists_of_different_components(spark, seed):
    rows = edited_chains(seed)
    assert got(similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80)) == by_all_pairs(rows, 3, 80)


def test_a_pair_is_counted_once_over_lists_of_either_main_component(spark):
    # Classes 1 and 2 share four lists; 3 and 4 make the component of 1 the main one of two lists and that of 2 of the others.
    lists = [(token, id) for token in range(4) for id in (1, 2, 3 if token < 2 else 4)]
    postings = spark.createDataFrame(
        [(token, id, 20, 4, token, 0, 25) for token, id in lists], "token long, id long, n int, k int, place int, lone int, most int")
    roots = spark.createDataFrame([(1, 1), (3, 1), (2, 2), (4, 2)], "node long, root long")
    assert [tuple(r) for r in cross_pairs(postings, roots, 80).collect()] == [(1, 2)]


def test_no_rows(empty):
    assert similar_groups(empty).collect() == []


def test_query_covers_all_documents(spark, sf, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert got(op1_ngram_join(spark, sf)) == by_all_pairs(rows, 3, 90)


@pytest.mark.parametrize("seed", range(5))
def test_similar_sets_share_k_prefix_shingles(seed):
    draw = np.random.default_rng(seed)
    size, percent = 200, 80
    base = draw.choice(10**6, size, replace=False)
    other = np.concatenate([base[:180], draw.choice(10**6, 20) + 10**6])
    order = {int(v): n for n, v in enumerate(draw.permutation(np.union1d(base, other)))}
    for k in (1, 5, 20):
        heads = [set(sorted(map(int, s), key=order.get)[:len(s) - needed(len(s), percent) + k]) for s in (base, other)]
        assert len(heads[0] & heads[1]) >= k


def test_costly_lists_ask_for_more_shared_shingles():
    places = np.arange(20)
    assert choose_k(places[:0], places[:0], 100, 80) == 1
    assert 1 < choose_k(places, np.full(20, 50), 100, 80) <= most_shared(100, 80)
    assert choose_k(places[:1], np.ones(1, int), 1, 80) == 1


def test_shingle_hashes_are_distinct_and_sorted():
    shingles = Shingles(3)
    texts = [b"a b c d e a b c", b"a b", b" \n", None, b"x a b c", b"a", b"b a"]
    sets = shingles.of(texts)
    assert [len(s) for s in sets] == [5, 1, 0, 0, 2, 1, 1]
    assert all(np.all(s[1:] > s[:-1]) for s in sets)
    # A set does not depend on its neighbours, and shares just the equal shingles.
    assert all((shingles.of([t])[0] == s).all() for t, s in zip(texts, sets))
    assert len(np.intersect1d(sets[0], sets[4])) == 1 and sets[1] != sets[6]


@pytest.mark.parametrize("seed", range(3))
def test_components_agree_with_union_find(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    roots = roots_of(200, links)
    assert found == {n: roots[n] for a, b in links if a != b for n in (a, b)}
