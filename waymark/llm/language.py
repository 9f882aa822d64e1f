"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the letters of a word in both directions, labels every byte position with a language, and a
document's probabilities are the mean over all its positions. States start anew at each word, so equal words have equal
labels: each task runs the network once per distinct word (a bounded memo) and adds up whole texts from that.

Training is backpropagation through time in one task, over a bounded sample: at most DOCS_PER_LANGUAGE documents of
each language, chosen by a hash of the id. The number of languages is the number of values the labels take.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm import gru
from waymark.llm.common import Work, held_out, map_slices, pick

FOLDS = 5
DOCS_PER_LANGUAGE = 250
STATE = 20
STEPS = 900
BATCH = 512
RATE = 0.01
# Longer words are read in parts.
PART = 24
MEMO_WORDS = 300_000
UNKNOWN = "und"
# Letters A-Z count as a-z; other ASCII ends a word; every byte beyond ASCII is part of one.
LETTERS = bytes(b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
HAS_ASCII_LETTER = re.compile(b"[A-Za-z]")


def parts(word: bytes) -> Iterator[bytes]:
    """At most PART bytes each, whole characters."""
    first = 0
    while len(word) - first > PART:
        past = first + PART
        while word[past] & 0xC0 == 0x80:
            past -= 1
        yield word[first:past]
        first = past
    yield word[first:]


def words_of(text: bytes) -> list[bytes]:
    words = text.translate(LETTERS).split()
    if any(len(w) > PART for w in words):
        return [part for w in words for part in parts(w)]
    return words


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (HAS_ASCII_LETTER.search(text) is not None or any(c.isalpha() for c in text.decode()))


def train(words: list[bytes], labels: np.ndarray, counts: np.ndarray, languages: int, seed: int = 0) -> gru.Weights:
    """Weights of the network after STEPS batches of words with the language of their document.

    Words are drawn by the square root of their counts: frequent ones more often, rare ones often enough.
    """
    rng = np.random.default_rng(seed)
    reached = np.cumsum(np.sqrt(counts))
    weights = {
        "in_on": gru.uniform(rng, 256, 3 * STATE), "in_back": gru.uniform(rng, 256, 3 * STATE),
        "U_on": gru.uniform(rng, STATE, 3 * STATE), "U_back": gru.uniform(rng, STATE, 3 * STATE),
        "b_on": np.zeros(3 * STATE, np.float32), "b_back": np.zeros(3 * STATE, np.float32),
        "out": gru.uniform(rng, 2 * STATE, languages), "bias": np.zeros(languages, np.float32),
    }
    adam = gru.Adam(weights, RATE)
    lengths = np.array([len(w) for w in words])
    for number in range(STEPS):
        chosen = np.searchsorted(reached, rng.random(BATCH) * reached[-1], side="right")
        size, longest = lengths[chosen], int(lengths[chosen].max())
        on, back = np.zeros((longest, BATCH), np.int64), np.zeros((longest, BATCH), np.int64)
        for column, i in enumerate(chosen):
            letters = np.frombuffer(words[i], np.uint8)
            on[:len(letters), column] = letters
            back[:len(letters), column] = letters[::-1]
        # Position t of a word meets position length-1-t of the word read backward.
        place = np.arange(longest)[:, None]
        inside = place < size
        mirror = np.where(inside, size - 1 - place, place)
        column = np.arange(BATCH)[None, :]
        start = np.zeros((BATCH, STATE), np.float32)
        h_on, kept_on = gru.train_forward(weights["in_on"][on], start, weights["U_on"], weights["b_on"])
        h_back, kept_back = gru.train_forward(weights["in_back"][back], start, weights["U_back"], weights["b_back"])
        state = np.concatenate([h_on, h_back[mirror, column]], axis=2)
        chance = softmax(state @ weights["out"] + weights["bias"])
        chance[place, column, labels[chosen][None, :]] -= 1
        chance *= (inside / inside.sum())[:, :, None].astype(np.float32)
        d_state = chance @ weights["out"].T
        d_back = np.empty_like(h_back)
        d_back[mirror, column] = d_state[:, :, STATE:]
        gradients = {
            "out": state.reshape(-1, 2 * STATE).T @ chance.reshape(-1, languages), "bias": chance.sum((0, 1)),
        }
        for way, symbols, d_h, kept in (("on", on, d_state[:, :, :STATE], kept_on), ("back", back, d_back, kept_back)):
            d_x, gradients[f"U_{way}"], gradients[f"b_{way}"] = gru.backward(d_h, kept, weights[f"U_{way}"])
            table = np.zeros((256, 3 * STATE), np.float32)
            np.add.at(table, symbols.reshape(-1), d_x.reshape(-1, 3 * STATE))
            gradients[f"in_{way}"] = table
        adam.update(gradients, scale=1 - number / STEPS)
    return weights


def softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    return logits


def label_words(words: list[bytes], weights: gru.Weights) -> np.ndarray:
    """Per word, the language probabilities added up over its positions."""
    out = np.empty((len(words), len(weights["bias"])), np.float32)
    lengths = np.array([len(w) for w in words])
    for size in np.unique(lengths):
        same = np.flatnonzero(lengths == size)
        for first in range(0, len(same), 4096):
            rows = same[first:first + 4096]
            letters = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(len(rows), size).T
            start = np.zeros((len(rows), STATE), np.float32)
            on = gru.forward(weights["in_on"][letters], start, weights["U_on"], weights["b_on"])
            back = gru.forward(weights["in_back"][letters[::-1]], start, weights["U_back"], weights["b_back"])[::-1]
            logits = on @ weights["out"][:STATE] + back @ weights["out"][STATE:] + weights["bias"]
            out[rows] = softmax(logits).sum(0)
    return out


class Labels(dict):
    """Numbers of distinct words; of each the summed label probabilities and, last, its bytes that training never saw."""

    def __init__(self, weights: gru.Weights) -> None:
        self.weights, self.fresh = weights, []
        self.seen = bytes(np.flatnonzero(weights["seen"]).tolist())
        self.sums = np.empty((0, len(weights["bias"]) + 1), np.float32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def totals(self, texts: list[list[bytes]]) -> np.ndarray:
        """The sums over all words of each text."""
        if len(self) > MEMO_WORDS:
            self.clear()
            self.sums = self.sums[:0]
        sizes = np.array([len(t) for t in texts], np.int64)
        numbers = np.fromiter((self[w] for t in texts for w in t), np.int64, int(sizes.sum()))
        strange = np.array([len(w.translate(None, self.seen)) for w in self.fresh], np.float32)
        self.sums = np.concatenate([self.sums, np.column_stack([label_words(self.fresh, self.weights), strange])])
        self.fresh = []
        text = np.repeat(np.arange(len(texts)), sizes)
        return np.stack([np.bincount(text, self.sums[numbers, k], len(texts)) for k in range(self.sums.shape[1])], axis=1)

    def pool(self, texts: list[list[bytes]]) -> np.ndarray:
        """Mean probabilities over the positions of each text; zero where there is no position."""
        return shares(self.totals(texts))


def shares(totals: np.ndarray) -> np.ndarray:
    return totals[:, :-1] / np.maximum(totals[:, :-1].sum(1, keepdims=True), 1e-9)


def seen_bytes(words: list[bytes]) -> np.ndarray:
    """1 for every byte that occurs."""
    return (np.bincount(np.frombuffer(b"".join(words), np.uint8), minlength=256) > 0).astype(np.float32)


def sample(rows: DataFrame, folds: int, per_language: int) -> DataFrame:
    """At most `per_language` labelled texts of each language: those with the least hashes outside the held-out fold.

    Sizes per language give a threshold on the hash that about twice as many rows pass, so that only these are ranked.
    """
    usable = rows.where(~F.col("held_out") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    usable = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("_hash"))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    share = 2.0 ** 65 * per_language / F.col("_rows") - 2.0 ** 63
    # One row per language; the network has a column for each, so they are few.
    near = usable.join(F.broadcast(sizes), "lang").where(F.col("_hash") <= F.least(share, F.lit(2.0 ** 63)))
    # Repeated rows count once.
    near = near.groupBy("lang", "_hash").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= per_language).select("lang", "text")


def fit(rows: DataFrame, folds: int, per_language: int) -> tuple[list[str], gru.Weights | None]:
    """The languages and the trained weights; none where no labelled text has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(
            (lang, word) for batch in batches for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for word in words_of(text.encode())
        )
        if counts:
            pairs = sorted(counts)
            languages = sorted({lang for lang, _ in pairs})
            numbers = {lang: n for n, lang in enumerate(languages)}
            labels, times = np.array([numbers[lang] for lang, _ in pairs]), np.array([counts[p] for p in pairs])
            words = [w for _, w in pairs]
            weights = {**train(words, labels, times, len(languages)), "seen": seen_bytes(words)}
            yield pa.RecordBatch.from_arrays([pa.array([languages]), pa.array([gru.packed(weights)])], names=["langs", "weights"])

    fitted = sample(rows, folds, per_language).coalesce(1).mapInArrow(run, "langs array<string>, weights binary").head()
    return ([], None) if fitted is None else (fitted["langs"], gru.unpacked(bytes(fitted["weights"])))


def identify_language(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = FOLDS,
    per_language: int = DOCS_PER_LANGUAGE, keep: bool = False,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, over_chance, n_letters and n_strange of every row.

    The score is the language's share of the positions. `over_chance` is how far it lies between an even share of all
    learned languages (0) and the whole (1), so that it means the same for any number of them. `n_letters` counts the
    positions, `n_strange` those of bytes that no text of the sample has.

    Labels of the held-out fold are never read. A missing text, one without letters, and every text where nothing could
    be learnt get `und` with score and further numbers 0. Map-only after training; equal texts get equal results, a missing id is its own
    value of the fold. With `keep` the row itself is a last column `_doc`.
    """
    rows = pick(docs, keep, doc_id=id, text=text, lang=lang).withColumns({
        "doc_id": F.col("doc_id").cast("long"), "lang": F.col("lang").cast("string"), "held_out": held_out(F.col("doc_id"), folds),
    })
    languages, weights = fit(rows, folds, per_language)
    content = docs.sparkSession.sparkContext.broadcast(weights)

    def begin() -> Work:
        labels = None if content.value is None else Labels(content.value)

        def work(ids: list, texts: list[bytes | None], held: list[bool]) -> list:
            if labels is None:
                return [ids, held, [UNKNOWN] * len(ids), *[[0.0] * len(ids)] * 2, *[[0] * len(ids)] * 2]
            known = [has_letter(t) for t in texts]
            words = [words_of(t) if ok else [] for t, ok in zip(texts, known)]
            totals = labels.totals(words)
            chances = shares(totals)
            best = chances.argmax(1)
            score = np.where(known, chances.max(1), 0.0)
            even = 1 / len(languages)
            over = (score - even) / (1 - even) if len(languages) > 1 else np.ones(len(ids))
            return [
                ids, held, [languages[b] if ok else UNKNOWN for b, ok in zip(best, known)], score, np.where(known, np.maximum(over, 0), 0.0),
                [sum(map(len, own)) for own in words], totals[:, -1].astype(np.int64),
            ]

        return work

    read = rows.select("doc_id", "text", "held_out", *(["_doc"] if keep else []))
    schema = "doc_id long, held_out boolean, lang_pred string, score double, over_chance double, n_letters long, n_strange long"
    return map_slices(read, begin, schema, keep=text if keep else None)
