from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import language
from waymark.llm.language import Labels, PART, UNKNOWN, has_letter, identify_language, label_words, words_of
from waymark.llm.queries import op5_language


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    monkeypatch.setattr(language, "STEPS", 400)


def test_query_is_accurate_on_held_out_documents(spark, sf, documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = op5_language(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    outside = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in outside) >= 0.95 * len(outside)


def test_odd_rows(both, edge):
    rows = identify_language(both).collect()
    assert len(rows) == both.count()
    odd = {r["doc_id"]: r for r in rows if r["doc_id"] is not None and r["doc_id"] < 1000}
    assert [odd[i]["lang_pred"] for i in (1, 2, 3, 8)] == [UNKNOWN] * 4
    # The generated languages are invented: real words need not look like theirs, but any word gets some language.
    assert all(odd[i]["lang_pred"] in ("de", "en", "es", "fr") for i in (9, 10, -11))
    kept = identify_language(edge, keep=True).select("_doc.*")
    assert kept.columns == edge.columns and kept.count() == edge.count()


def test_labels_of_the_held_out_fold_are_not_read(both):
    changed = both.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "xx").otherwise(F.col("lang")))
    order = ["doc_id", "score"]
    assert identify_language(changed.where("doc_id is not null")).orderBy(*order).collect() == \
        identify_language(both.where("doc_id is not null")).orderBy(*order).collect()


def test_nothing_to_learn(empty, edge):
    assert identify_language(empty).collect() == []
    assert {r["lang_pred"] for r in identify_language(edge.withColumn("lang", F.lit(None).cast("string"))).collect()} == {UNKNOWN}


def test_memo_gives_what_the_network_gives(monkeypatch):
    monkeypatch.setattr(language, "MEMO_WORDS", 3)
    words = [b"the", b"and", b"le", b"la"]
    weights = {**language.train(words, np.array([0, 0, 1, 1]), np.ones(4), 2), "seen": language.seen_bytes(words)}
    texts = [[b"the", b"le", b"the"], [], [b"la", b"and", b"x" * PART], [b"the"]]
    labels = Labels(weights)
    for _ in range(2):
        pooled = labels.pool(texts)
        for text, row in zip(texts, pooled):
            want = label_words(text, weights).sum(0) if text else np.zeros(2)
            assert row == pytest.approx(want / max(want.sum(), 1e-9), abs=1e-5)


def test_words_and_letters():
    assert words_of(b"The 2 cats, l'eau") == [b"the", b"cats", b"l", b"eau"]
    assert b"".join(words_of(b"y" * 100)) == b"y" * 100 and max(map(len, words_of(b"y" * 100))) == PART
    for text in ("é" * 50, "a" + "é" * 50, "日" * 50, "ab" + "\U0001F600" * 20):
        cut = words_of(text.encode())
        assert "".join(w.decode() for w in cut) == text and max(map(len, cut)) <= PART
    assert has_letter("é".encode()) and not has_letter("— 12 …".encode()) and not has_letter(None)


def test_bytes_that_training_never_saw_are_counted():
    weights = {**language.train([b"the", b"le"], np.array([0, 1]), np.ones(2), 2), "seen": language.seen_bytes([b"the", b"le"])}
    assert Labels(weights).totals([[b"the", b"hex"], [], ["é".encode()]])[:, -1].tolist() == [1, 0, 2]


def test_over_chance_has_one_scale(spark, documents):
    """With one language everything is whole; with several an even share is 0."""
    one = identify_language(documents.where("lang = 'en'").limit(50)).collect()
    assert {r["over_chance"] for r in one if r["lang_pred"] != UNKNOWN} == {1.0}
    rows = [r for r in identify_language(documents.where("lang in ('en', 'de')")).collect() if r["lang_pred"] != UNKNOWN]
    assert all(r["over_chance"] == pytest.approx(2 * r["score"] - 1, abs=1e-6) for r in rows)
    assert all(0 <= r["n_strange"] <= r["n_letters"] for r in rows)
