from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from waymark.llm import gru, language_model
from waymark.llm.language_model import END, Network, Words, score_documents
from waymark.llm.queries import op3_lm_scoring


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def check_base(found, rows):
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        want[i, held(i), len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)] += 1
    assert Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found
    ) == want


def test_query_scores_beat_the_base(spark, sf, documents):
    found = op3_lm_scoring(spark, sf).collect()
    check_base(found, [(r["doc_id"], r["text"]) for r in documents.collect()])
    outside = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in outside) > sum(r["base_score"] for r in outside)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_odd_rows_and_rare_words(both, monkeypatch):
    # Most words are beyond the counted ones and come through the join.
    monkeypatch.setattr(language_model, "COUNTED", 40)
    monkeypatch.setattr(language_model, "HEAD", 20)
    monkeypatch.setattr(language_model, "CLASSES", 4)
    check_base(score_documents(both).collect(), [(r["doc_id"], r["text"]) for r in both.collect()])


def test_no_rows_and_nothing_to_learn(spark, empty):
    assert score_documents(empty).collect() == []
    only = next(i for i in range(100) if held(i))
    row = score_documents(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"], row["score"]) == (0, 0, 0.0, 0.0)


def small_words(head):
    names = [END, *[f"w{i}" for i in range(60)]]
    return Words(names, np.arange(len(names) + 10, 10, -1), 5000, 200)


@pytest.fixture
def network(monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 30)
    monkeypatch.setattr(language_model, "CLASSES", 5)
    network = Network(small_words(30))
    rng = np.random.default_rng(1)
    for name in ("class", "word", "in"):
        network.weights[name] = rng.normal(0, 0.3, network.weights[name].shape).astype(np.float32)
    return network


def test_probabilities_add_up_to_one(network):
    states = language_model.with_one(np.random.default_rng(0).normal(0, 1, (1, language_model.STATE)).astype(np.float32))
    every = np.arange(network.words.head + 1)
    logs = network.log_probs(np.repeat(states, len(every), axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    # The words of the last class share its probability by smoothed counts, one share for all unseen words.
    rest = network.words
    seen = rest.counts[rest.head:].sum() + 0.1 * len(rest.counts[rest.head:])
    beyond = (rest.rest - rest.counts[rest.head:].sum()) + 0.1 * (rest.rest_distinct - len(rest.counts[rest.head:])) + 0.1
    assert (seen + beyond) / (rest.rest + 0.1 * (rest.rest_distinct + 1)) == pytest.approx(1)


def test_state_is_carried_across_windows(network):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 31, n) for n in (200, 1, 33, 64, 200, 5)]
    whole = network.score(docs)
    w = network.weights
    for doc, score in zip(docs, whole):
        h, before, total = np.zeros((1, language_model.STATE), np.float32), network.words.end, 0.0
        for word in doc:
            h = gru.step(w["in"][[before]], h, w["U"], w["b"])[0]
            total += float(network.log_probs(language_model.with_one(h), np.array([word]))[0])
            before = int(word)
        assert score == pytest.approx(total, rel=1e-4)


def test_windows_of_few_rows_are_looked_up_together(network, monkeypatch):
    calls = []
    plain = network.log_probs
    monkeypatch.setattr(network, "log_probs", lambda states, words: calls.append(len(words)) or plain(states, words))
    docs = [np.random.default_rng(3).integers(0, 31, n) for n in (4000, 70, 0)]
    whole = network.score(docs)
    assert calls == [4070]
    monkeypatch.setattr(language_model, "POSITIONS", 1)
    assert network.score(docs) == pytest.approx(whole, rel=1e-6)
    assert whole[2] == 0 and len(network.score([])) == 0


def test_gates_lie_in_a_piece():
    rng = np.random.default_rng(4)
    U, b, start = gru.uniform(rng, 4, 12), rng.normal(0, 0.1, 12).astype(np.float32), np.zeros((3, 4), np.float32)
    xs = rng.normal(0, 1, (5, 3, 12)).astype(np.float32)
    states, kept = gru.train_forward(gru.apart(xs), start, U, b)
    assert np.array_equal(states, gru.forward(xs, start, U, b)) and np.array_equal(states[0], gru.step(xs[0], start, U, b)[0])
    update, reset = kept[1]
    assert update.flags.c_contiguous and reset.flags.c_contiguous and update.shape == (5, 3, 4)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    U, b = gru.uniform(rng, 4, 12), rng.normal(0, 0.1, 12).astype(np.float32)
    xs = rng.normal(0, 1, (5, 3, 12)).astype(np.float32)
    d_out = rng.normal(0, 1, (5, 3, 4)).astype(np.float32)
    start = np.zeros((3, 4), np.float32)

    def loss(U, xs):
        return float((gru.forward(xs, start, U, b).astype(float) * d_out).sum())

    _, kept = gru.train_forward(xs, start, U, b)
    d_xs, d_U, _ = gru.backward(d_out, kept, U)
    for array, gradient, with_array in ((U, d_U, lambda v: loss(v, xs)), (xs, d_xs, lambda v: loss(U, v))):
        for _ in range(10):
            at = tuple(rng.integers(0, n) for n in array.shape)
            up, down = array.copy(), array.copy()
            up[at] += 1e-2
            down[at] -= 1e-2
            assert (with_array(up) - with_array(down)) / 2e-2 == pytest.approx(float(gradient[at]), abs=2e-2)


def test_training_lowers_the_loss(network):
    # Word 2 follows 1 and 1 follows 2.
    text = np.tile([1, 2], 4000)
    before = network.score([text[:500]])[0]
    network.train(gru.Adam(network.weights, 0.01), text)
    assert network.score([text[:500]])[0] > 0.8 * before
