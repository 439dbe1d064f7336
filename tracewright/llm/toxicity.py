"""Toxic documents by a lexicon that also meets misspelled terms.

The lexicon is learned: terms, and stems that take many endings, which stand in
toxic documents of the sample in many surroundings and hardly anywhere else.  A
trie of the lexicon is intersected with the Levenshtein automata of its terms;
the product is made deterministic state by state as words ask for it, so a word
costs one lookup per character until it can no longer match.  Hits inside
quotation marks or near verbs of reporting are counted apart from the others, as
are hits near a second person, and a logistic model learned from the sample
weighs them; each term has its own learned weight at each distance, so words
that merely resemble a term count for little.

The model is fitted on at most ``sample`` labelled rows, chosen by a hash of the
id outside the held-out fold; everything else reads all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, held_out, labelled_texts, release, texts_of

SAMPLE, TERMS, WINDOW, SUPPORT, PRECISION = 12_000, 400, 6, 6, 0.8
_STEMS, _ENDINGS = (4, 5, 6, 7, 8), 4
_CACHE, _STATES = 150_000, 40_000
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "«»„“”‘’¿¡…–—"
#: Quotation marks, verbs of reporting and second persons.
QUOTES = set("\"«»„“”")
REPORTS = {"said", "says", "say", "wrote", "writes", "quoted", "quote", "called", "sagte", "schrieb", "zitiert", "dit", "écrit", "cité", "dijo", "escribió", "citó"}
PERSONS = {"you", "your", "you're", "yourself", "u", "du", "dich", "dir", "ihr", "tu", "toi", "te", "vous", "tú", "usted", "vosotros"}


def clean(token: str) -> str:
    return token.strip(_EDGE)


def edits_for(term: str) -> int:
    """Edits allowed: none below 5 letters, one below 8, else two."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """The lexicon's trie under the Levenshtein automata of its terms, made deterministic as needed.

    A state is a set of (trie node, edits so far).  Reaching the end of a stem
    without an edit accepts at once, whatever follows.
    """

    def __init__(self, terms: list[str], stems: list[str]):
        self.terms, self.stems = terms, stems
        self.children: list[dict[str, int]] = [{}]
        self.term_at: dict[int, str] = {}
        self.stem_at: dict[int, str] = {}
        self.limit = [0]
        for words, ends in ((terms, self.term_at), (stems, self.stem_at)):
            for t in words:
                node, most = 0, edits_for(t) if ends is self.term_at else 0
                self.limit[0] = max(self.limit[0], most)
                for c in t:
                    if c not in self.children[node]:
                        self.children.append({})
                        self.limit.append(0)
                        self.children[node][c] = len(self.children) - 1
                    node = self.children[node][c]
                    self.limit[node] = max(self.limit[node], most)
                ends[node] = t
        self._reset()

    def __getstate__(self):
        return {"terms": self.terms, "stems": self.stems}

    def __setstate__(self, s):
        self.__init__(s["terms"], s["stems"])

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: list[dict[str, int]] = []
        self.hit: list[str | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of the state with these nodes, letters of the terms skipped included; -1 for none."""
        todo = list(nodes.items())
        while todo:  # a term's letter that the word lacks
            node, e = todo.pop()
            if nodes[node] == e:
                for child in self.children[node].values():
                    if e + 1 <= self.limit[child] and e + 1 < nodes.get(child, 99):
                        nodes[child] = e + 1
                        todo.append((child, e + 1))
        if not nodes:
            return -1
        key = tuple(sorted(nodes.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
            self.hit.append(min((self.stem_at[n] for n, e in key if e == 0 and n in self.stem_at), default=None))
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.limit[node] and e < out.get(node, 99):
                out[node] = e

        for node, e in self.states[state]:
            put(node, e + 1)  # a letter too many
            for letter, child in self.children[node].items():
                put(child, e + (letter != c))
        self.next[state][c] = to = self._state(out)
        return to

    def find(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest entry that the word matches; stems end with an asterisk."""
        if len(self.states) > _STATES:
            self._reset()
        state = self.start
        for c in word:
            to = self.next[state].get(c)
            if to is None:
                to = self._step(state, c)
            if to < 0:
                return None
            if self.hit[to] is not None:
                return self.hit[to] + "*", 0
            state = to
        best = min(((e, self.term_at[n]) for n, e in self.states[state] if n in self.term_at and e <= edits_for(self.term_at[n])), default=None)
        return (best[1], best[0]) if best else None


class Scanner:
    """Finds hits in texts; remembers words met before, hits apart from the rest."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.known: dict[str, None] = {}
        self.hits: dict[str, tuple[str, int]] = {}

    def __getstate__(self):
        return {"automaton": self.automaton}

    def __setstate__(self, s):
        self.__init__(s["automaton"])

    def scan(self, text: str) -> tuple[int, list[tuple[str, int, bool, bool]]]:
        """(words, hits): each hit with its term, edits, whether it is quoted, whether a second person is near."""
        words = text.lower().split()
        kinds = set(words)
        if len(self.known) > _CACHE:  # stems take any ending, so hits grow with the texts as well
            self.known.clear()
            self.hits.clear()
        for w in kinds.difference(self.known):
            self.known[w] = None
            found = self.automaton.find(clean(w))
            if found:
                self.hits[w] = found
        if kinds.isdisjoint(self.hits.keys()):
            return len(words), []
        out, opened = [], False
        for i, w in enumerate(words):
            marks = sum(c in QUOTES for c in w) if not QUOTES.isdisjoint(w) else 0
            if w in self.hits:
                near = {clean(x) for x in words[max(0, i - WINDOW) : i + WINDOW + 1]}
                out.append((*self.hits[w], opened or marks > 0 or not near.isdisjoint(REPORTS), not near.isdisjoint(PERSONS)))
            if marks % 2:
                opened = not opened
            if opened and w[-1:] in ".!?" and not marks and i % WINDOW == 0:
                opened = False  # a mark that is never closed ends near a sentence's end
        return len(words), out


def _lexicon(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Terms and stems with support in many surroundings of toxic documents and next to none elsewhere.

    Support counts different preceding words, so that copies of one document do not
    lend their words support.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around: set[tuple[str, int, int]] = set()
        plain: Counter = Counter()
        for b in batches:
            for text, toxic in zip(texts_of(b), b.column(1).to_pylist(), strict=True):
                words = [clean(w) for w in text.lower().split()]
                if toxic:
                    for before, w in zip(["", *words], words):
                        if len(w) > 2 and w.isalpha():
                            h = xxhash.xxh32_intdigest(before)
                            around.add((w, h, 0))
                            around.update((w[:n] + "*", h, xxhash.xxh32_intdigest(w)) for n in _STEMS if len(w) > n)
                else:
                    own = {w for w in words if len(w) > 2 and w.isalpha()}
                    plain.update(own)
                    plain.update({w[:n] + "*" for w in own for n in _STEMS if len(w) > n})
        rows = [*((w, h, e, 0) for w, h, e in around), *((w, 0, 0, n) for w, n in plain.items())]
        for lo in range(0, len(rows), 100_000):
            w, h, e, n = zip(*rows[lo : lo + 100_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(h, pa.int64()), pa.array(e, pa.int64()), pa.array(n, pa.int64())], ["w", "h", "e", "n"])

    toxic = F.col("n") == 0
    rows = sample.select("text", "label").mapInArrow(run, "w string, h long, e long, n long").distinct()
    found = rows.groupBy("w").agg(
        F.count_distinct(F.when(toxic, F.col("h"))).alias("support"), F.count_distinct(F.when(toxic, F.col("e"))).alias("endings"), F.sum("n").alias("plain")
    )
    good = found.filter((F.col("support") >= SUPPORT) & (F.col("support") >= PRECISION * (F.col("support") + F.col("plain"))) & (~F.col("w").endswith("*") | (F.col("endings") >= _ENDINGS)))
    kept = good.orderBy(F.desc("support"), "w").limit(8 * TERMS).collect()
    support = {r["w"][:-1]: r["support"] for r in kept if r["w"].endswith("*")}
    stems: list[str] = []
    for stem in sorted(support, key=lambda x: (len(x), -support[x], x)):
        if any(stem.startswith(s) for s in stems):
            continue
        while True:  # a longer stem that keeps nearly all support says more
            longer = [x for x in support if len(x) == len(stem) + 1 and x.startswith(stem) and support[x] >= 0.95 * support[stem]]
            if not longer:
                break
            stem = longer[0]
        if stem not in stems:
            stems.append(stem)
    terms = [r["w"] for r in kept if not r["w"].endswith("*") and not any(r["w"].startswith(s) for s in stems)]
    return terms[:TERMS], stems[:TERMS]


class Model:
    """Weights per term and distance, and the logistic layer over a document's hits."""

    def __init__(self, scanner: Scanner, weight: dict[tuple[str, int], float], base: dict[int, float], beta: np.ndarray):
        self.scanner, self.weight, self.base, self.beta = scanner, weight, base, beta

    def features(self, text: str) -> np.ndarray:
        n, hits = self.scanner.scan(text)
        return features(n, hits, self.weight, self.base)

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.stack([self.features(t) for t in texts]) if texts else np.zeros((0, len(self.beta)))
        return 1 / (1 + np.exp(-np.clip(x @ self.beta, -40, 40)))


def features(n: int, hits, weight, base) -> np.ndarray:
    """1, weight of the strongest open hit, of all open hits, of the strongest quoted hit, of hits near a second person, share of hits."""
    w = [(weight.get((t, e), base[e]), quoted, person) for t, e, quoted, person in hits]
    opened, quoted = [x for x, q, _ in w if not q], [x for x, q, _ in w if q]
    return np.array([1.0, max(opened, default=0.0), math.log1p(max(0.0, sum(opened))), max(quoted, default=0.0), max((x for x, _, p in w if p), default=0.0), math.sqrt(len(hits) / n) if n else 0.0])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 25) -> np.ndarray:
    """Newton's method with a ridge on all but the first column."""
    beta = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-4
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (p - y) + pull * beta
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(h, g)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model, or None where no labelled row outside the held-out fold exists."""
    rows = labelled_texts(docs, labels, "toxic", sample)
    scanner = Scanner(Automaton(*_lexicon(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scanner.scan(t) for t in texts_of(b)]
            hits = [[{"t": t, "e": e, "q": q, "p": p} for t, e, q, p in h] for _, h in found]
            kind = pa.list_(pa.struct([("t", pa.string()), ("e", pa.int32()), ("q", pa.bool_()), ("p", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([n for n, _ in found], pa.int64()), pa.array(hits, kind)], ["doc_id", "label", "n", "hits"])

    got = rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, n long, hits array<struct<t: string, e: int, q: boolean, p: boolean>>").collect()
    drop_table(rows)
    if not got:
        return None
    got.sort(key=lambda r: (r["doc_id"], r["n"]))
    y = np.array([r["label"] for r in got], np.float64)
    hits = [[(h["t"], h["e"], h["q"], h["p"]) for h in r["hits"]] for r in got]
    toxic, plain = max(1.0, y.sum()), max(1.0, len(y) - y.sum())
    # Documents with a term at a distance, toxic or not; few sightings stay near the figures of the whole distance.
    count = {(k, c): 0.0 for c in (0, 1) for k in {(t, e) for h in hits for t, e, _, _ in h}}
    for h, label in zip(hits, y.astype(int).tolist(), strict=True):
        for k in {(t, e) for t, e, _, _ in h}:
            count[k, label] += 1
    odds = lambda a, b: math.log((a / toxic) / (b / plain))
    base = {e: odds(2.0 / (e + 1), 0.5 * plain / len(y)) for e in (0, 1, 2)}
    weight = {k: max(0.0, odds(count[k, 1] + 2.0 / (k[1] + 1), count[k, 0] + 0.5 * plain / len(y))) for k, c in count if c == 1}
    x = np.stack([features(r["n"], h, weight, base) for r, h in zip(got, hits, strict=True)])
    return Model(scanner, weight, base, logistic(x, y))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (of label 1), predicted (score >= threshold).

    Null and empty texts have no hit and get the score of such documents.  Without
    a labelled row outside the held-out fold every score is 0.  Repeated rows and
    null ids stay (a null id is not held out); an empty table gives no row.
    """
    model = fit(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b)
            s = model.score(texts) if model is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all their columns; all rows if nothing can be learned.

    Null and empty texts have no hit, null ids and repeated rows are judged by their
    text like any other row, columns of any name come through as they are, and an
    empty table gives no row.
    """
    model = fit(docs, labels, sample)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield b.filter(pa.array(model.score(texts_of(b)) < threshold))
        release()

    return docs.mapInArrow(run, docs.schema)
