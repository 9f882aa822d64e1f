from __future__ import annotations

import random
from itertools import cycle

import numpy as np
import pytest

from waymark.llm.queries import op9_substrings
from waymark.llm.substrings import LEAST_CHUNK, LEAST_SPAN, MOST_CHUNK, REACH, chunk_ends, common_length, gear_hashes, gear_table, remove_repeats


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(words))


def shared_windows(texts, size=50):
    seen: dict[tuple, set] = {}
    for number, text in enumerate(texts):
        words = (text or "").split()
        for start in range(len(words) - size + 1):
            seen.setdefault(tuple(words[start:start + size]), set()).add(number)
    return {w for w, own in seen.items() if len(own) > 1}


def test_query_removes_repeated_passages(spark, sf, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = op9_substrings(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert r["n_bytes"] == len(data) and r["n_removed"] == sum(s["past"] - s["first"] for s in r["spans"])
        left, last = b"", 0
        for span in r["spans"]:
            assert span["past"] - span["first"] >= LEAST_SPAN and span["first"] >= last
            left += data[last:span["first"]]
            last = span["past"]
        assert r["text"] == (left + data[last:]).decode(errors="ignore")
    before, after = shared_windows(texts.values()), shared_windows(r["text"] for r in rows)
    assert before and len(after) <= 0.02 * len(before)


def test_first_copy_stays_and_others_lose_the_passage(spark):
    passage = prose(0, 80)
    rows = [(3, prose(1, 100) + " " + passage + " " + prose(2, 100)), (1, passage + " " + prose(3, 100)), (2, prose(4, 100)), (7, "x " + passage)]
    found = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["n_removed"] == found[2]["n_removed"] == 0
    for i in (3, 7):
        assert len(passage) <= found[i]["n_removed"] <= len(passage) + 2
    # Every word of the corpus's distinct text is still there once.
    assert passage in found[1]["text"]


def test_odd_rows(edge, empty):
    rows = remove_repeats(edge).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in edge.collect())
    assert {r["doc_id"]: r["text"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == {1: None, 2: "", 3: " \n\t ", 7: "a"}
    assert remove_repeats(empty).collect() == []


def test_all_copies_but_one_go(spark):
    text = prose(5, 400)
    rows = remove_repeats(spark.createDataFrame([(i % 3, text) for i in range(9)], "doc_id long, text string")).collect()
    assert sorted(r["n_removed"] for r in rows)[0] == 0
    assert all(r["n_removed"] == len(text) for r in sorted(rows, key=lambda r: r["n_removed"])[1:])


def test_rolling_hash_by_doubling():
    table, data = gear_table(), np.random.default_rng(0).integers(0, 256, 500).astype(np.uint8)
    value, want = 0, []
    for byte in data:
        value = (2 * value + int(table[byte])) % 2**32
        want.append(value)
    assert gear_hashes(data, table).tolist() == want


@pytest.mark.parametrize("data", [b"", b"a", b"ab" * 2000, prose(6, 500).encode()])
def test_chunks_cover_the_text(data):
    ends = chunk_ends(np.frombuffer(data, np.uint8), gear_table())
    sizes = np.diff([0, *ends])
    assert (ends[-1] if ends else 0) == len(data)
    assert all(LEAST_CHUNK <= s <= MOST_CHUNK for s in sizes[:-1]) and all(0 < s <= MOST_CHUNK for s in sizes)


def test_an_insertion_moves_only_near_cuts():
    text, table = prose(7, 1000).encode(), gear_table()
    changed = text[:2000] + b" inserted words " + text[2000:]

    def chunks(data):
        ends = chunk_ends(np.frombuffer(data, np.uint8), table)
        return {data[a:b] for a, b in zip([0, *ends], ends)}

    assert len(chunks(text) - chunks(changed)) <= 6


def test_rows_keep_their_numbers_when_cores_come_and_go(spark, documents, tmp_path, monkeypatch):
    """A scan is split anew when executors are lost between two jobs."""
    from waymark.llm import substrings

    path = str(tmp_path / "documents")
    documents.repartition(12).write.parquet(path)
    setting, cores = "spark.sql.leafNodeDefaultParallelism", cycle([3, 5, 2, 7, 3, 4, 6, 2, 5, 3])
    plain = {(r["doc_id"], r["text"], r["n_removed"]) for r in remove_repeats(spark.read.parquet(path)).collect()}
    own = substrings.saved

    def saved(df, name):
        out = own(df, name)
        spark.conf.set(setting, next(cores))
        return out

    monkeypatch.setattr(substrings, "saved", saved)
    try:
        spark.conf.set(setting, 4)
        moved = {(r["doc_id"], r["text"], r["n_removed"]) for r in remove_repeats(spark.read.parquet(path)).collect()}
    finally:
        spark.conf.unset(setting)
    assert sum(n for _, _, n in moved) == sum(n for _, _, n in plain) and len(moved ^ plain) <= 0.02 * len(plain)


@pytest.fixture(scope="module")
def passages(spark):
    """600 passages of 51 words, each in two texts with words of their own around it, and what is removed of the later ones."""
    rows = []
    for i in range(600):
        passage = prose(10_000 + i, 51)
        rows += [(2 * i + k, f"{prose(20_000 + 2 * i + k, 60)} {passage} {prose(40_000 + 2 * i + k, 60)}", passage) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, passage string")
    found = {r["doc_id"]: r for r in remove_repeats(docs).collect()}
    return [(found[i], text, passage) for i, text, passage in rows]


def test_passages_of_51_words_go_to_their_exact_ends(passages):
    missed = removed = total = 0
    for row, text, passage in passages:
        if row["doc_id"] % 2 == 0:
            assert row["n_removed"] == 0
            continue
        missed += not row["spans"]
        removed += row["n_removed"] if row["spans"] else 0
        total += len(passage) if row["spans"] else 0
        for span in row["spans"]:
            # A letter beyond the passage may be the same by chance.
            first = text.index(passage)
            assert first - 8 <= span["first"] <= first and first + len(passage) <= span["past"] <= first + len(passage) + 8
    assert missed <= 6 and removed >= 0.98 * total


def test_every_removed_span_stands_earlier(spark):
    """Plain search: each span of one source is a substring of the texts before it, and no character is cut."""
    shared = [prose(i, 70) + " naïve 日本語 " + prose(100 + i, 30) for i in range(3)]
    rows = [(i, f"é{prose(200 + i, 40)} 日{shared[i % 3]}本 {prose(300 + i, 40)}") for i in range(9)]
    found = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        data, before = text.encode(), "\n".join(t for j, t in rows if j < i).encode()
        assert (len(found[i]["spans"]) > 0) == (i >= 3)
        for span in found[i]["spans"]:
            piece = data[span["first"]:span["past"]]
            assert piece in before and shared[i % 3] in piece.decode()
        assert len(found[i]["text"].encode()) == found[i]["n_bytes"] - found[i]["n_removed"]


def test_ends_beyond_the_first_reach_are_found(spark):
    """Bytes without cuts are chunked from the cut before them, so their chunks differ though the bytes are the same."""
    passage = prose(8, 40) + "a" * (9 * REACH) + "b" * (30 * REACH) + prose(9, 40)
    rows = [(i, f"{prose(50 + i, 30)}{'c' * (31 * i)}{passage}{prose(60 + i, 30)}") for i in range(3)]
    found = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (1, 2):
        assert found[i]["n_removed"] >= len(passage) and passage not in found[i]["text"]


@pytest.mark.parametrize("one, other, want", [(b"", b"a", 0), (b"a", b"b", 0), (b"ab", b"ac", 1), (b"abc", b"abcd", 3), (b"x" * 99 + b"y", b"x" * 120, 99)])
def test_common_length(one, other, want):
    assert common_length(one, other) == common_length(other, one) == want


def test_pieces_of_long_texts_give_the_same_spans(spark, monkeypatch):
    from waymark.llm import substrings

    shared = [prose(i, 60 + 40 * i) for i in range(6)]
    rows = [(i, " ".join(f"{prose(500 + 10 * i + k, 30)} {shared[(i * k + k) % 6]}" for k in range(8))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted((r["doc_id"], r["text"], str(r["spans"])) for r in remove_repeats(docs).collect())
    monkeypatch.setattr(substrings, "PIECE", 2 * REACH)
    assert sorted((r["doc_id"], r["text"], str(r["spans"])) for r in remove_repeats(docs).collect()) == whole
    assert any(spans != "[]" for _, _, spans in whole)
