"""Document quality from random-indexing word vectors and a small network.

Every word has a sparse random index vector drawn from its hash; the vector of a
word is the sum of the index vectors found near it in the learning sample.  Words
outside the bounded vocabulary share the vector of their shape (runs of upper
case, lower case, digits and each punctuation mark).  A document is the mean of
its word vectors with two figures about repetition and length.  A two-layer
numpy network scores it; a temperature fitted on rows the weights never saw
calibrates the probabilities.

The classifier is fitted on at most ``sample`` labelled rows, chosen by a hash of
the id outside the held-out fold; everything else reads all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, held_out, labelled_texts, release, texts_of

SAMPLE, VOCABULARY, DIM, NONZERO, WINDOW, HIDDEN = 6000, 6000, 64, 6, 2, 24
_CACHE = 150_000
_MARKS = ".,;:!?*#$%&|"
_ROWS = "doc_id long, label int, features array<double>"


def _runs(word: str, most: int) -> str:
    out: list[str] = []
    for c in word:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != k:
            if len(out) == most:
                break
            out.append(k)
    return "".join(out)


def shape(word: str) -> str:
    """Kinds of characters in a row, each run once, eight runs at most."""
    body = word.rstrip(_MARKS)
    tail = word[len(body) :]
    if body.isalpha() and (body[1:].islower() or len(body) == 1) and len(tail) < 2:
        return ("\x00Aa" if len(body) > 1 else "\x00A") + tail if body[0].isupper() else "\x00a" + tail
    return "\x00" + _runs(word, 8)


def index_vector(token: str, dim: int = DIM) -> np.ndarray:
    out = np.zeros(dim, np.float32)
    h = xxhash.xxh64_intdigest(token, 17)
    rng = np.random.Generator(np.random.PCG64(h))
    out[rng.choice(dim, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


@dataclass
class Words:
    """Token numbers: a vocabulary word's own, else that of the word's shape, else 0."""

    number: dict[str, int]
    cache: dict[str, int] = field(default_factory=dict)

    def __getstate__(self):
        return {"number": self.number, "cache": {}}

    def __len__(self):
        return len(self.number) + 1

    def _find(self, word: str) -> int:
        n = self.number.get(word)
        return self.number.get(shape(word), 0) if n is None else n

    def ids(self, words: list[str]) -> np.ndarray:
        cache = self.cache
        try:
            return np.array(list(map(cache.__getitem__, words)), np.int64)
        except KeyError:
            if len(cache) > _CACHE:
                cache.clear()
            for w in set(words).difference(cache):
                cache[w] = self._find(w)
            return np.array(list(map(cache.__getitem__, words)), np.int64)


@dataclass
class Model:
    words: Words
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.tanh((features - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -40, 40)))


def document_vector(text: str, words: Words, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, share of repeated words (sum of squared frequencies), log length."""
    out = np.zeros(vectors.shape[1] + 2)
    w = text.split()
    if w:
        counts = np.bincount(words.ids(w), minlength=0)
        some = np.flatnonzero(counts)
        out[:-2] = counts[some] @ vectors[some] / len(w)
        times = np.fromiter(Counter(w).values(), np.float64)
        out[-2] = np.sqrt((times * times).sum()) / len(w)
        out[-1] = np.log1p(len(w))
    return out


def _vocabulary(sample: DataFrame, size: int) -> Words:
    """The most frequent words and shapes of the sample by the number of documents they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in texts_of(b):
                w = set(t.split())
                seen.update(w)
                seen.update({shape(x) for x in w})
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    found = sample.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = found.filter("n >= 3").orderBy(F.desc("n"), "token").limit(size).collect()
    return Words({r["token"]: i + 1 for i, r in enumerate(rows)})


def _vectors(sample: DataFrame, words: Words) -> np.ndarray:
    """Context vectors: each task sums its part of the sample, the driver adds a bounded matrix per task."""
    index = np.stack([index_vector(t) for t in ["", *words.number]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(index.shape)
        for b in batches:
            for t in texts_of(b):
                ids = words.ids(t.split())
                near = np.zeros((len(ids), index.shape[1]))
                for d in range(1, WINDOW + 1):
                    near[d:] += index[ids[:-d]]
                    near[:-d] += index[ids[d:]]
                np.add.at(total, ids, near)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["m"])

    total = np.zeros(index.shape)
    for r in sample.select("text").coalesce(6).mapInArrow(run, "m binary").toLocalIterator():
        total += np.frombuffer(r["m"], np.float32).reshape(total.shape)
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(norm > 0, norm, 1)).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = 400, rate: float = 0.02, decay: float = 1e-3, seed: int = 7):
    """Weights of the two-layer network by Adam over all rows, and the temperature of the logits."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = (x - mean) / scale
    tune = rng.random(len(x)) < 0.8
    if tune.all() or not tune.any():
        tune[:] = True
    prior = np.clip(y.mean(), 0.01, 0.99)
    p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.array(np.log(prior / (1 - prior)))]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    a, t = z[tune], y[tune]
    for step in range(1, steps + 1):
        h = np.tanh(a @ p[0] + p[1])
        out = 1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40)))
        d = (out - t) / len(t)
        back = np.outer(d, p[2]) * (1 - h * h)
        grads = [a.T @ back + decay * p[0], back.sum(0), h.T @ d + decay * p[2], d.sum()]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    rest = ~tune if (~tune).any() else tune
    logits = np.tanh(z[rest] @ p[0] + p[1]) @ p[2] + p[3]
    sign = 2 * y[rest] - 1
    temps = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, -sign * logits / k).mean() for k in temps]
    return mean, scale, p[0], p[1], p[2], float(p[3]), float(temps[int(np.argmin(loss))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model | None:
    """The model, or None where no labelled row outside the held-out fold exists."""
    rows = labelled_texts(docs, labels, "quality", sample)
    words = _vocabulary(rows, vocabulary)
    vectors = _vectors(rows, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [document_vector(t, words, vectors).tolist() for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "features"])

    got = sorted(rows.select("doc_id", "text", "label").mapInArrow(run, _ROWS).collect(), key=lambda r: (r[0], r[2]))
    drop_table(rows)
    if not got:
        return None
    x, y = np.array([r[2] for r in got]), np.array([r[1] for r in got], np.float64)
    return Model(words, vectors, *train(x, y))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (of label 1), predicted (score >= threshold).

    Null and empty texts are scored like any other, from zero vectors.  Without a
    labelled row outside the held-out fold every score is 0.5.  Repeated rows and
    null ids stay (a null id is not held out); an empty table gives no row.
    """
    model = fit(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b)
            if model is None or not texts:
                s = np.full(len(texts), 0.5)
            else:
                s = model.score(np.stack([document_vector(t, model.words, model.vectors) for t in texts]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` scored at least ``threshold``, with all their columns; all rows if nothing can be learned.

    Null and empty texts are scored as such, null ids and repeated rows are judged by
    their text like any other row, columns of any name come through as they are, and
    an empty table gives no row.
    """
    model = fit(docs, labels, sample)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                s = model.score(np.stack([document_vector(t, model.words, model.vectors) for t in texts_of(b)]))
                yield b.filter(pa.array(s >= threshold))
        release()

    return docs.mapInArrow(run, docs.schema)
