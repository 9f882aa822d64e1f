from __future__ import annotations

import zlib
from collections import defaultdict

import pytest

from waymark.llm import sharding
from waymark.llm.queries import op2_sharding
from waymark.llm.sharding import least_loaded, room, shard_documents


def check(rows, texts, shards):
    """The contract: sizes, checksums, groups together, gapless slots, nearly equal bytes."""
    expected = sorted(
        (-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots, loads, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        homes[r["size"], r["text_crc32"]].add(r["shard"])
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    # Missing and empty texts have the same checksum but are two groups.
    assert all(len(found) == 1 for key, found in homes.items() if key != (1, 0))
    return loads


def test_query_is_balanced(spark, sf, documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    loads = check(op2_sharding(spark, sf).collect(), texts, 16)
    groups = defaultdict(int)
    for _, text in texts:
        groups[text] += len(text.encode()) + 1
    fair = sum(groups.values()) / 16
    assert max(loads.values()) <= 4 / 3 * max(fair, max(groups.values()))


def test_odd_rows(edge):
    check(shard_documents(edge, 4).collect(), [(r["doc_id"], r["text"]) for r in edge.collect()], 4)


def test_no_rows(empty):
    assert shard_documents(empty).collect() == []


def test_blocks_fill_the_room_beside_a_huge_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HEAD", 2)
    monkeypatch.setattr(sharding, "BLOCK_GROUPS", 50)
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_TASK", 37)
    texts = [(i, "copy" * 10) for i in range(400)] + [(1000 + i, "t" * (i % 40) + str(i)) for i in range(1000)]
    loads = check(shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect(), texts, 8)
    others = sorted(loads.values())[:-1]
    assert max(others) - min(others) < 0.05 * max(others)


def test_heap_gives_the_largest_to_the_least_loaded():
    assert least_loaded([7, 5, 4, 3, 1], [0, 0]) == [0, 1, 1, 0, 1]
    assert least_loaded([3], [2.0, 1.0]) == [1]


@pytest.mark.parametrize(("loads", "rest"), [([0, 0], 10), ([100, 0, 0], 10), ([5, 4, 3], 0), ([9, 1, 5], 5)])
def test_room_adds_up(loads, rest):
    assert sum(room(loads, rest)) == pytest.approx(rest)
