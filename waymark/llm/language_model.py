"""A gated recurrent language model over words: class-factored softmax, truncated backpropagation, whole documents scored.

Vocabulary. The tokens of all training documents are counted. The HEAD most frequent are the network's own words, in CLASSES
classes of equal sums of root counts; all others form one more class, whose words follow their smoothed counts. So the
probabilities of all words, unseen ones included, add up to 1 at every position.

Training. A short run on a bounded sample (WARM_DOCS documents) gives every task the same start; then each task trains on
all of its own training documents, and the weights are averaged by tokens. Sums of weights go through a
shuffle in parts, so neither the driver nor a task holds more than a few models.

Scoring. Documents run side by side, longest first, in windows of STEPS words; the state is carried over from window to
window, so the score is that of the complete document. Counts of words beyond the COUNTED most frequent, which
go to all tasks, are joined by a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.llm import gru
from waymark.llm.common import Work, ascii_words, held_out, map_slices, pick, saved

FOLDS = 10
HEAD = 2048
CLASSES = 24
COUNTED = 1 << 16
STATE = 16
STEPS = 32
STREAMS = 256
WARM_DOCS = 2000
WARM_RATE, RATE = 0.01, 0.003
SMOOTH = 0.1
END = ""  # no word is empty
SLICE = 16 << 20
SLICE_DOCS = 20_000
PART = 8192  # numbers per row where weights are added up
ABREAST = 2048  # documents per step when scoring
POSITIONS = 8192  # so many at least are looked up in the classes together


class Words:
    """The counted words from the most frequent on, and what the network needs to know of them."""

    def __init__(self, words: list[str], counts: np.ndarray, tokens: int, distinct: int) -> None:
        self.words, self.counts, self.tokens, self.distinct = words, counts, tokens, distinct
        self.head = min(HEAD, len(words))
        self.end = words.index(END)
        mass = np.sqrt(counts[:self.head].astype(float))
        classes = np.minimum((np.cumsum(mass) - mass) / max(mass.sum(), 1e-9) * CLASSES, CLASSES - 1).astype(np.int64)
        self.starts = np.searchsorted(classes, np.arange(CLASSES + 1))
        self.class_of = np.append(classes, CLASSES)  # the last for all words beyond the head
        self.rest = tokens - int(counts[:self.head].sum())
        self.rest_distinct = distinct - self.head

    def parts(self) -> tuple:
        """What makes an equal object; plain data, so that tasks can read it."""
        return self.words, self.counts, self.tokens, self.distinct

    def numbers(self, most: int | None = None) -> dict[bytes, int]:
        return {word.encode(): n for n, word in enumerate(self.words[:most])}


class Network:
    """The last column of `word` and the last row of `class` are biases, met by a state that is always 1."""

    def __init__(self, words: Words, weights: gru.Weights | None = None) -> None:
        self.words = words
        if weights is None:
            rng = np.random.default_rng(0)
            counts = words.counts[:words.head].astype(float)
            sums = [counts[a:b].sum() for a, b in zip(words.starts, words.starts[1:])]
            weights = {
                "in": rng.normal(0, 0.1, (words.head + 1, 3 * STATE)).astype(np.float32),
                "U": gru.uniform(rng, STATE, 3 * STATE), "b": np.zeros(3 * STATE, np.float32),
                "class": np.zeros((STATE + 1, CLASSES + 1), np.float32), "word": np.zeros((words.head, STATE + 1), np.float32),
            }
            weights["class"][-1] = np.log(np.maximum([*sums, words.rest], SMOOTH) / max(words.tokens, 1))
            weights["word"][:, -1] = np.log(counts / counts.max())
        self.weights = weights

    def bound(self) -> None:
        """Keeps every logit within 60 of zero: their exponentials then need no shift by the row's maximum."""
        for weights, axis in ((self.weights["class"], 0), (self.weights["word"], 1)):
            weights /= np.maximum(np.abs(weights).sum(axis, keepdims=True) / 60, 1)

    def _by_class(self, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, int, int]]]:
        """Positions in order of their words' classes; for each class of several words that is met, its slice of them and its first and
        past-last word."""
        order = np.argsort(classes.astype(np.uint8), kind="stable")
        edges = [0, *np.cumsum(np.bincount(classes, minlength=CLASSES + 1)).tolist()]
        words = list(map(int, self.words.starts))
        return order, [
            (slice(edges[k], edges[k + 1]), words[k], words[k + 1])
            for k in range(CLASSES) if edges[k + 1] > edges[k] and words[k + 1] - words[k] > 1
        ]

    def log_probs(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability; for words beyond the head that of their class."""
        w, classes = self.weights, self.words.class_of[words]
        out = _log_softmax_at(states @ w["class"], classes)
        order, parts = self._by_class(classes)
        states, words, inner = states[order], words[order], np.zeros(len(words), np.float32)
        for own, first, past in parts:
            inner[own] = _log_softmax_at(states[own] @ w["word"][first:past].T, words[own] - first)
        out[order] += inner
        return out

    def train(self, adam: gru.Adam, tokens: np.ndarray) -> None:
        """One pass over a sequence of documents, each closed by the end: parallel streams, gradients cut at each window."""
        w, end = self.weights, self.words.end
        streams = int(np.clip(len(tokens) // (4 * STEPS), 1, STREAMS))
        length = -(-len(tokens) // (streams * STEPS)) * STEPS
        # Filled up with ends that carry no loss.
        stream = np.full(streams * length, end, np.int64)
        stream[:len(tokens)] = tokens
        real = (np.arange(streams * length) < len(tokens)).reshape(streams, length).T
        stream = stream.reshape(streams, length).T
        before = np.concatenate([np.full((1, streams), end), stream[:-1]])
        h = np.zeros((streams, STATE), np.float32)
        for t in range(0, length, STEPS):
            symbols, target, counts = before[t:t + STEPS], stream[t:t + STEPS].reshape(-1), real[t:t + STEPS].reshape(-1)
            number = int(counts.sum())
            if not number:
                break
            out, kept = gru.train_forward(gru.apart(w["in"]).take(symbols, axis=1), h, w["U"], w["b"])
            h = out[-1]
            states = with_one(out)
            classes = self.words.class_of[target]
            d = _softmax_gradient(states @ w["class"], classes)
            if number < len(counts):
                d[~counts] = 0
            gradients = {"class": states.T @ d / number, "word": np.zeros_like(w["word"])}
            d_states = d @ w["class"][:-1].T
            if number < len(counts):
                classes = np.where(counts, classes, CLASSES)
            order, parts = self._by_class(classes)
            states, target, inner = states[order], target[order], np.zeros_like(d_states)
            for own, first, past in parts:
                d = _softmax_gradient(states[own] @ w["word"][first:past].T, target[own] - first)
                gradients["word"][first:past] = d.T @ states[own] / number
                np.matmul(d, w["word"][first:past, :-1], out=inner[own])
            d_states[order] += inner
            d_states /= number
            d_x, gradients["U"], gradients["b"] = gru.backward(d_states.reshape(out.shape), kept, w["U"])
            flat = symbols.reshape(-1).astype(np.uint16 if self.words.head < 1 << 16 else np.int64)
            order = np.argsort(flat, kind="stable")
            rows = flat[order]
            starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            gradients["in"] = np.add.reduceat(d_x.reshape(-1, 3 * STATE)[order], starts, axis=0)
            adam.update(gradients, rows={"in": rows[starts].astype(np.int64)})
            self.bound()

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Sum of log_probs over each document's words, which are numbers below head, or head for all others."""
        w = self.weights
        inputs = gru.apart(w["in"])
        out = np.zeros(len(docs))
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        positions = 0

        def add() -> None:
            """The classes are gone through once for many windows, since long documents leave windows of few rows."""
            nonlocal positions
            found = self.log_probs(*(np.concatenate([item[n] for item in waiting]) for n in (0, 1)))
            ends = np.cumsum([len(words) for _, words, _, _ in waiting])
            for own, (_, _, inside, docs) in zip(np.split(found, ends[:-1]), waiting):
                logs = np.zeros(len(inside), np.float32)
                logs[inside] = own
                out[docs] += logs.reshape(-1, len(docs)).sum(0, dtype=np.float64)
            waiting.clear()
            positions = 0

        order = np.argsort([-len(d) for d in docs], kind="stable")
        for first in range(0, len(order), ABREAST):
            group = order[first:first + ABREAST]
            sizes = np.array([len(docs[i]) for i in group])
            flat = np.concatenate([docs[i] for i in group])
            begins = np.cumsum(sizes) - sizes
            h = np.zeros((len(group), STATE), np.float32)
            last = np.full(len(group), self.words.end)
            for t in range(0, int(sizes[0]), STEPS):
                active = int(np.searchsorted(-sizes, -t, side="left"))
                places = np.arange(t, min(t + STEPS, int(sizes[0])))[:, None]
                real = places < sizes[:active]
                words = np.where(real, flat.take(places + begins[:active], mode="clip"), self.words.end)
                symbols = np.concatenate([last[None, :active], words[:-1]])
                states = gru.forward(inputs.take(symbols, axis=1), h[:active], w["U"], w["b"])
                h, last = states[-1], words[-1]
                inside = real.reshape(-1)
                waiting.append((with_one(states)[inside], words.reshape(-1)[inside], inside, group[:active]))
                positions += len(waiting[-1][1])
                if positions >= POSITIONS:
                    add()
        if waiting:
            add()
        return out


def with_one(states: np.ndarray) -> np.ndarray:
    """All positions' states in rows, each with a 1 behind."""
    out = np.ones((*states.shape[:-1], states.shape[-1] + 1), np.float32)
    out[..., :-1] = states
    return out.reshape(-1, out.shape[-1])


def _log_softmax_at(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    at = logits[np.arange(len(chosen)), chosen]
    return at - np.log(np.exp(logits, out=logits).sum(1))


def _softmax_gradient(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    np.exp(logits, out=logits)
    logits *= 1 / logits.sum(1, keepdims=True)
    logits[np.arange(len(chosen)), chosen] -= 1
    return logits


def count_tokens(rows: DataFrame) -> DataFrame:
    """word and c over all given texts, one END for each text."""

    def begin() -> Work:
        def work(texts: list[bytes | None]) -> list:
            counts: Counter[bytes] = Counter()
            for text in texts:
                counts.update(ascii_words(text))
            counts[b""] += len(texts)
            return [pa.array(list(counts), pa.binary()).cast(pa.string()), list(counts.values())]

        return work

    counts = map_slices(rows.select("text"), begin, "word string, c long", widest=0, slice_bytes=SLICE, slice_rows=SLICE_DOCS)
    return counts.groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame) -> Words | None:
    """The COUNTED most frequent words with the totals; none without training documents."""
    tokens, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    if not tokens:
        return None
    end = counts.where(F.col("word") == END)
    top = counts.where(F.col("word") != END).orderBy(F.desc("c"), "word").limit(COUNTED - 1).unionByName(end).toPandas()
    top = top.sort_values(["c", "word"], ascending=[False, True], kind="stable")
    # The end is one of the network's own words, however rare it is.
    first = top["word"].eq(END)
    top = top[~first].iloc[:HEAD - 1]._append(top[first])._append(top[~first].iloc[HEAD - 1:])
    return Words(top["word"].tolist(), top["c"].to_numpy(np.int64), int(tokens), int(distinct))


def _sequence(texts: list[bytes | None], numbers: dict[bytes, int], words: Words) -> np.ndarray:
    """The words of all texts by the numbers of the head, an end after each text."""
    out = []
    for text in texts:
        own = ascii_words(text)
        out.append(np.fromiter(map(numbers.get, own, repeat(words.head)), np.int64, len(own)))
        out.append(np.array([words.end]))
    return np.concatenate(out)


def fit(rows: DataFrame, words: Words) -> gru.Weights:
    """Weights trained on all `rows` (doc_id, text)."""
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast(words.parts())

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*known.value)
        network, numbers = Network(words), words.numbers(words.head)
        adam = gru.Adam(network.weights, WARM_RATE)
        texts = [t.encode() if t else b"" for batch in batches for t in batch.column(0).to_pylist()]
        if texts:
            network.train(adam, _sequence(texts, numbers, words))
        yield pa.RecordBatch.from_arrays([pa.array([gru.packed(network.weights)])], names=["weights"])

    # A share of the rows by a hash of their place; there are as many rows as ends.
    share = WARM_DOCS / int(words.counts[words.end])
    chosen = F.pmod(F.xxhash64("_row"), F.lit(1 << 40)) < int(share * (1 << 40))
    sample = rows.where(chosen).select("text").repartition(1)
    warm = spark.sparkContext.broadcast(bytes(sample.mapInArrow(start, "weights binary").head()["weights"]))
    shapes = {name: value.shape for name, value in gru.unpacked(warm.value).items()}

    def begin() -> Work:
        words = Words(*known.value)
        network, numbers = Network(words, gru.unpacked(warm.value)), words.numbers(words.head)
        adam = gru.Adam(network.weights, RATE)
        seen = 0

        def work(texts: list[bytes | None] | None = None) -> list:
            nonlocal seen
            if texts is not None:
                tokens = _sequence(texts, numbers, words)
                network.train(adam, tokens)
                seen += len(tokens)
                return [[], [], []]
            flat = np.concatenate([network.weights[name].reshape(-1) for name in shapes]).astype(np.float64) * seen
            parts = [flat[i:i + PART] for i in range(0, len(flat), PART)] if seen else []
            return [list(range(len(parts))), [seen] * len(parts), [p.astype("<f8").tobytes() for p in parts]]

        return work

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        tokens: Counter[int] = Counter()
        for batch in batches:
            for part, n, values in zip(*[c.to_pylist() for c in batch.columns]):
                tokens[part] += n
                values = np.frombuffer(values, "<f8")
                sums[part] = sums[part] + values if part in sums else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([tokens[p] for p in sums], pa.int64()),
             pa.array([sums[p].tobytes() for p in sums], pa.binary())], names=["part", "tokens", "values"])

    schema = "part int, tokens long, values binary"
    trained = map_slices(rows.select("text"), begin, schema, widest=0, end=True, slice_bytes=SLICE, slice_rows=SLICE_DOCS)
    added = trained.repartition("part").mapInArrow(add, schema).orderBy("part").toArrow()
    flat = np.concatenate([np.frombuffer(v, "<f8") / n for v, n in zip(added["values"].to_pylist(), added["tokens"].to_pylist())])
    weights, place = {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        weights[name] = flat[place:place + size].reshape(shape).astype(np.float32)
        place += size
    return weights


PARTS = (
    "doc_id long, _row long, held_out boolean, n_tokens long, _known long, _counted double, _network double, _beyond double, "
    "_outside long, _words array<string>, _times array<int>"
)


def score_texts(rows: DataFrame, words: Words | None, weights: gru.Weights | None) -> DataFrame:
    """What each document's score is made of, all but the counts of its rarest words, which it lists."""
    content = rows.sparkSession.sparkContext.broadcast((words and words.parts(), weights))
    lists = [field.type for field in to_arrow_schema(T.StructType.fromDDL(PARTS))][-2:]

    def begin() -> Work:
        parts, weights = content.value
        words = Words(*parts) if parts else None
        if words is not None:
            network, numbers = Network(words, weights), words.numbers()
            logs = np.log10(words.counts + SMOOTH)

        def work(ids: list, texts: list[bytes | None], row: list[int], held: list[bool]) -> list:
            sequences, columns = [], [[] for _ in range(5)]
            rare_words: list[bytes] = []
            rare_times: list[int] = []
            bounds = [0]
            for text in texts:
                own = ascii_words(text)
                if words is None:
                    found, sequence = np.full(len(own) + 1, -1), np.zeros(0, np.int64)
                    counted = beyond = known = outside = 0
                else:
                    found = np.append(np.fromiter(map(numbers.get, own, repeat(-1)), np.int64, len(own)), words.end)
                    sequence = np.where((found < 0) | (found >= words.head), words.head, found)
                    inside = found[found >= 0]
                    known, counted = len(inside), float(logs[inside].sum())
                    beyond, outside = float(logs[inside[inside >= words.head]].sum()), int((sequence == words.head).sum())
                rare = Counter(compress(own, (found[:-1] < 0).tolist()))
                rare_words.extend(rare)
                rare_times.extend(rare.values())
                bounds.append(len(rare_words))
                sequences.append(sequence)
                for column, value in zip(columns, (len(own) + 1, known, counted, beyond, outside)):
                    column.append(value)
            scores = np.zeros(len(ids)) if words is None else network.score(sequences) / np.log(10)
            n, known, counted, beyond, outside = columns
            values = pa.array(rare_words, pa.binary()).cast(lists[0].value_type), pa.array(rare_times, lists[1].value_type)
            rare = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), v, type=kind) for v, kind in zip(values, lists)]
            return [ids, row, held, n, known, counted, scores, beyond, outside, *rare]

        return work

    return map_slices(rows.select("doc_id", "text", "_row", "held_out"), begin, PARTS, slice_bytes=SLICE, slice_rows=SLICE_DOCS)


def score_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row.

    Missing and empty texts are the end alone. Nothing is learnt from the held-out fold; where all rows are held out, or
    there are none, nothing is known, and the score is the base score: each token is the one unseen word. Repeated rows
    count and are scored one by one; a missing id is text without characters to the fold.
    """
    rows = pick(docs, doc_id=id, text=text).select(
        F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"), held_out(F.col("doc_id"), folds).alias("held_out")
    )
    training = rows.where(~F.col("held_out"))
    counts = saved(count_tokens(training), "token-counts")
    words = frequent(counts)
    weights = fit(training, words) if words else None
    parts = saved(score_texts(rows, words, weights), "score-parts")
    tokens, distinct = (words.tokens, words.distinct) if words else (0, 0)
    rest, rest_distinct = (words.rest, words.rest_distinct) if words else (0, 0)

    rare = parts.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("r")).select("_row", "r._words", "r._times")
    found = rare.join(counts.withColumnRenamed("word", "_words"), "_words", "left")
    c = F.coalesce("c", F.lit(0))
    sums = found.groupBy("_row").agg(
        F.sum(F.col("_times") * F.log10(c + SMOOTH)).alias("_rare"), F.sum(F.when(c > 0, F.col("_times")).otherwise(0)).alias("_rare_known"),
    )
    rare_sum = F.coalesce("_rare", F.lit(0.0))
    # Without training documents the end is not among the counted words.
    missing = F.lit(0.0 if words else float(np.log10(SMOOTH)))
    base = F.col("_counted") + rare_sum + missing - F.col("n_tokens") * float(np.log10(tokens + SMOOTH * (distinct + 1)))
    score = F.col("_network") + F.col("_beyond") + rare_sum - F.col("_outside") * float(np.log10(rest + SMOOTH * (rest_distinct + 1)))
    return parts.drop("_words", "_times").join(sums, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("_known") + F.coalesce("_rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (score if words else base).alias("score"),
    )
