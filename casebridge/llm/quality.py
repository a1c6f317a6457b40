"""Text quality by random-indexing word vectors, pooled per document, and a two-layer network.

A word's index vector is sparse, random and fixed by its hash. Its context vector is the sum of the index vectors of
the words beside it in the texts of all documents, the left ones rotated by one place so that order counts. The word
vector is the index vector plus the unit context vector. Words are runs of letters, of digits or of one symbol, hashed to
``BUCKETS`` places, so the model has a fixed size. Beside its spelling every word has a form (kind, length, case) and
marks for being repeated; forms have index vectors too. A document is the mean of its words' vectors, the mean of its
forms' vectors, and its length.

The network (one hidden layer, numpy, Adam, fixed seed) learns on four fifths of a sample of about ``SAMPLE`` labelled
rows, picked by a hash of the id; on the last fifth one temperature is fitted to calibrate its probabilities. Sums of
context vectors are of integers, so the order of tasks does not matter. Several labels of one id: the largest counts.

Null and empty texts have the vector of no words and get a score like any other. With no labels, or one label only,
every score is the share of label 1 (0.5 without labels). Texts count whole; no column but id and text is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.llm.words import IDENTITY, NOT_SPACE, Words, mixed, slices, utf8

SAMPLE = 8_000
BUCKETS = 1 << 15
DIMENSIONS = 64
NONZERO = 4
HIDDEN = 32
EPOCHS = 300
CUTOFF = 0.3
SLICE_BYTES = 1 << 18
#: Least number of tasks that sum context vectors, and the most splits of the scan one takes.
CONTEXT_TASKS, SPLITS_A_TASK = 8, 4

# Kinds of bytes: letters (and all of UTF-8 beyond ASCII) 1, digits 2, every symbol its own.
KINDS = IDENTITY.copy()
KINDS[48:58] = 2
for _low, _high in ((65, 91), (97, 123), (128, 256)):
    KINDS[_low:_high] = 1


def _index_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index vectors of all buckets, and the places and signs that make them up."""
    random = np.random.default_rng(11)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.int32)
    drawn = [(random.integers(0, DIMENSIONS, BUCKETS), random.choice(np.array([-1, 1], np.int32), BUCKETS)) for _ in range(NONZERO)]
    for places, signs in drawn:
        vectors[np.arange(BUCKETS), places] += signs
    return vectors, np.stack([p for p, _ in drawn]), np.stack([s for _, s in drawn]).astype(np.int64)


INDEX, PLACES, SIGNS = _index_vectors()


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(64 - 15)).astype(np.int64)


def _words(column: pa.Array) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Slices of the column: words, their buckets, and bytes of each text."""
    data, offsets = utf8(column)
    for a, b in slices(offsets, SLICE_BYTES):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], NOT_SPACE, kinds=KINDS)
        yield words, _buckets(words.hash), np.diff(offsets[a : b + 1])


def _documents(column: pa.Array) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the column: words, their buckets, the buckets of their forms, and bytes of each text."""
    for words, ids, size in _words(column):
        first = words.bytes[words.start]
        second = words.bytes[np.minimum(words.start + 1, np.maximum(words.end - 1, 0))]
        length = np.minimum(words.end - words.start, 15).astype(np.uint64)
        upper = (first >= 65) & (first <= 90)
        case = upper.astype(np.uint64) + (upper & (second >= 65) & (second <= 90) & (length > 1))
        again = np.zeros(len(first), np.uint64)
        for back in (1, 2, 3):
            again[back:] |= (words.hash[back:] == words.hash[:-back]).astype(np.uint64) << np.uint64(back)
        runs = mixed(words.hash[2:] + mixed(words.hash[1:-1] + mixed(words.hash[:-2])))
        for i in range(len(size)):  # a run of three words that the text had before
            s, e = words.of_text[i], words.of_text[i + 1] - 2
            if e > s:
                _, back_to, at = np.unique(runs[s:e], return_index=True, return_inverse=True)
                again[s + 2 : e + 2] |= (back_to[at] != np.arange(e - s)).astype(np.uint64)
        again[words.of_text[:-1][words.of_text[:-1] < words.of_text[1:]]] = 0
        kind = KINDS[first].astype(np.uint64)
        form = (((kind << np.uint64(4)) | length) << np.uint64(2) | case) + np.uint64(1)
        forms = np.stack([_buckets(form), np.where(again, _buckets(again + np.uint64(1 << 40)), -1)], axis=1)
        yield words, ids, forms, size


def add_contexts(total: np.ndarray, column: pa.Array) -> None:
    """Add the context vectors over the texts of a column to ``total``."""
    flat = total.reshape(-1)
    for words, ids, _ in _words(column):
        begins = np.zeros(len(ids) + 1, bool)
        begins[words.of_text] = True
        inner = ~begins[1:-1] if len(ids) else begins[:0]
        left, right = ids[:-1][inner], ids[1:][inner]
        for places, signs in zip(PLACES, SIGNS, strict=True):
            np.add.at(flat, left * DIMENSIONS + places[right], signs[right])
            np.add.at(flat, right * DIMENSIONS + (places[left] + 1) % DIMENSIONS, signs[left])


def context_sums(column: pa.Array) -> np.ndarray:
    """Context vectors of all buckets over the texts of a column."""
    total = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    add_contexts(total, column)
    return total


def word_vectors(context: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(context, axis=1, keepdims=True)
    own = INDEX / np.sqrt(NONZERO)
    return (own + np.divide(context, size, out=np.zeros(context.shape), where=size > 0)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row per text: mean word vector, mean form vector, length."""
    form_vectors = (INDEX / np.sqrt(NONZERO)).astype(np.float32)
    rows = []
    for words, ids, forms, size in _documents(column):
        counts = np.diff(words.of_text)
        out = np.zeros((len(counts), 2 * DIMENSIONS + 1), np.float32)
        words_in = vectors[ids]
        forms_in = form_vectors[forms[:, 0]]
        marked = forms[:, 1] >= 0
        forms_in[marked] += form_vectors[forms[marked, 1]]
        each = np.ones(counts.max(initial=0), np.float32)
        for i in np.flatnonzero(counts):
            own, n = slice(words.of_text[i], words.of_text[i + 1]), counts[i]
            out[i, :DIMENSIONS] = each[:n] @ words_in[own] / n
            out[i, DIMENSIONS:-1] = each[:n] @ forms_in[own] / n
        out[:, -1] = np.log1p(size)
        rows.append(out)
    return np.concatenate(rows) if rows else np.zeros((0, 2 * DIMENSIONS + 1), np.float32)


@dataclass
class Network:
    """Standardised input, one hidden layer, a logit divided by the temperature."""

    center: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.center) / self.spread @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit on four of five rows, calibrate on the fifth. Without both labels the score is the share of label 1."""
    width = x.shape[1]
    share = float(y.mean()) if len(y) else 0.5
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if len(y) < 10 or share in (0.0, 1.0):
        net.second_bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    aside = np.arange(len(y)) % 5 == 4
    fit_x, fit_y = x[~aside].astype(np.float64), y[~aside]
    net.center, net.spread = fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-6
    random = np.random.default_rng(3)
    weights = [random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.array(0.0)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    scaled = (fit_x - net.center) / net.spread
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(fit_y))
        for rows in np.array_split(order, max(1, len(order) // 512)):
            a, target = scaled[rows], fit_y[rows]
            hidden = np.tanh(a @ weights[0] + weights[1])
            gap = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -40, 40))) - target) / len(rows)
            back = np.outer(gap, weights[2]) * (1 - hidden**2)
            slopes = [a.T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ gap + 1e-4 * weights[2], gap.sum()]
            step += 1
            rate = 0.003 * (1 - epoch / EPOCHS)
            for i, slope in enumerate(slopes):
                m, v = moments[i]
                m = 0.9 * m + 0.1 * slope
                v = 0.999 * v + 0.001 * slope**2
                moments[i] = (m, v)
                weights[i] = weights[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.first, net.first_bias, net.second, net.second_bias = weights[0], weights[1], weights[2], float(weights[3])
    z, target = net.logits(x[aside].astype(np.float64)), y[aside]
    if 0 < target.mean() < 1:
        choices = np.geomspace(0.25, 8, 121)
        losses = [np.mean(np.logaddexp(0, z / t) - target * z / t) for t in choices]
        net.temperature = float(choices[int(np.argmin(losses))])
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def contexts(texts: DataFrame) -> np.ndarray:
    """Context vectors of all buckets over every row of ``text``: one table a task, summed by bucket."""
    places = [f"v{k}" for k in range(DIMENSIONS)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMENSIONS), np.int64)
        for batch in batches:
            add_contexts(total, batch.column(0))
        met = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), *(pa.array(total[met, k]) for k in range(DIMENSIONS))], names=["bucket", *places])

    # Tables are as large as they get after some megabytes of text, so a task takes a few splits of the scan, never more.
    tasks = max(CONTEXT_TASKS, ceil(texts.rdd.getNumPartitions() / SPLITS_A_TASK))
    parts = texts.coalesce(tasks).mapInArrow(sums, ", ".join(["bucket int", *(f"{p} long" for p in places)]))
    found = parts.groupBy("bucket").agg(*[F.sum(p).alias(p) for p in places]).toArrow()
    context = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    context[found.column("bucket").to_numpy()] = np.stack([found.column(p).to_numpy() for p in places], axis=1)
    return context


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Word vectors from all texts, and the network from labelled rows where ``learnable`` (on the id) holds."""
    usable = labels.where(learnable & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    total = usable.count()
    limit = int(min(1.0, SAMPLE / max(total, 1)) * (1 << 20))
    picked = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < limit)  # about SAMPLE rows: small enough to broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(picked), "id").repartition(CONTEXT_TASKS, "id").sortWithinPartitions("id")
    vectors = word_vectors(contexts(texts.select("text")))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = sorted(sample.mapInArrow(features, f"id {kind}, label double, x binary").collect(), key=lambda r: (r["id"], bytes(r["x"])))
    x = np.stack([np.frombuffer(bytes(r["x"]), np.float32) for r in rows]) if rows else np.zeros((0, 2 * DIMENSIONS + 1), np.float32)
    return Model(vectors, train(x, np.array([r["label"] for r in rows], float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.network.probabilities(pooled(batch.column(1), shared.value.vectors))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"{id_col} {kind}, score double")
