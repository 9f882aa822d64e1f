from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import manifest
from waymark.llm.manifest import OpenSubtrees, fold, folded, merkle_manifest, siblings_digest
from waymark.llm.queries import manifest_check, op13_merkle_manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Levels of a tree, from the leaves up."""
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def route(levels, i):
    """The others of the node's run on each level, with the node's place in the run."""
    out = []
    for below in levels[:-1]:
        run = below[i // 2 * 2:i // 2 * 2 + 2]
        out.append((run[:i % 2], run[i % 2 + 1:]))
        i //= 2
    return out


def want(rows):
    """By the rule, one tree after the other."""
    groups = defaultdict(list)
    for r in rows:
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        changed = list(values)
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] is not None and r["n_chars"] is not None:
            changed[3] += 1
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(values), leaf_of(changed), r["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, _, leaf, _, _ in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = Counter()
    for place, g in enumerate(names):
        for i, (_, _, leaf, changed, doc) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*route(trees[g], i), *route(top, place)]
            root = changed
            for left, right in steps:
                root = sha("".join([*left, root, *right]))
            proof = sha("".join(d for left, right in steps for d in [*left, *right]))
            out[doc, leaf, trees[g][-1][0], top[-1][0], proof, root, root == top[-1][0]] += 1
    return out


def have(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_query(spark, sf, documents):
    found = have(op13_merkle_manifest(spark, sf))
    assert found == want(documents.collect())
    assert {k[-1] for k in found} == {True, False}


@pytest.fixture(scope="module")
def rows(spark):
    """A group of 37, one of one row, one without a name, many small ones; repeated ids and rows, missing values."""
    made = [(i, "s", "en", 3, f"t{i}") for i in range(37)]
    made += [(5, "s", "en", 3, "t5"), (5, "s", "en", 4, "other"), (5, None, "en", None, None), (None, "s", "en", 3, "x"), (None, "s", "en", 3, "y")]
    made += [(100, "s", "", 0, ""), (101, "s", None, 1, "é"), (102, "s", None, None, "日"), (103, None, None, None, None)]
    made += [(200 + i, "s", f"l{i % 19}", i, "z") for i in range(60)] + [(300, "s", "é", 1, "a"), (301, "s", "Z", 1, "a"), (302, "s", "\U0001F600", 1, "a"), (303, "s", "￼", 1, "a")]
    return spark.createDataFrame(made, "doc_id long, source string, lang string, n_chars int, text string")


@pytest.mark.parametrize("levels", [1, 2, 3, 12])
def test_blocks_of_several_sizes(rows, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 1 << levels)
    assert have(manifest_check(rows)) == want(rows.collect())


def test_other_partitions_give_the_same(rows):
    assert have(manifest_check(rows.repartition(13, "n_chars"))) == want(rows.collect())


def test_one_row_and_none(spark, rows):
    one = rows.where("doc_id = 100")
    assert have(manifest_check(one)) == want(one.collect())
    assert manifest_check(rows.where("false")).collect() == []


def test_clashing_columns(edge):
    docs = edge.selectExpr("doc_id", "text", "lang", "_row as source", "score as n_chars", "_doc as _at", "n_tokens as _group")
    assert have(manifest_check(docs)) == want(docs.collect())


def test_a_manifest_without_tampering_folds_to_its_root(rows):
    made = folded(merkle_manifest(rows), "leaf").collect()
    assert len(made) == rows.count() and all(r["folded_root"] == r["root"] for r in made)
    positions = Counter(r["subroot"] for r in made)
    assert {s: sorted(r["position"] for r in made if r["subroot"] == s) for s in positions} == {s: list(range(n)) for s, n in positions.items()}


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 70), st.integers(0, 4))
def test_appended_witnesses_against_whole_trees(n, further):
    leaves = [sha(str(i)) for i in range(n)]
    levels = tree(leaves)
    subtrees = OpenSubtrees()
    for leaf in leaves:
        subtrees.append(leaf)
    # Raised beyond its last node, a tree goes on with lone nodes.
    for _ in range(further):
        levels.append([sha(levels[-1][0])])
    root = subtrees.close(len(levels) - 1 if further else None)
    assert root == levels[-1][0]
    for i, path in enumerate(subtrees.paths):
        assert fold(leaves[i], bytes(path)) == root
        others = [d for left, right in route(levels, i) for d in [*left, *right]]
        assert siblings_digest(bytes(path)) == sha("".join(others))
