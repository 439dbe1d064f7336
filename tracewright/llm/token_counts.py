"""Token counts of whole texts, encoded in batches inside an Arrow function.

A text is cut where the tokenizer cuts it anyway: before a space that stands
between two characters that are not white space.  The pre-tokenizer of a
byte-level vocabulary never lets a token cross such a place, so the counts of
the parts add up to the count of the text and long texts need no long calls.  Parts
go to the library in batches of about equal bytes; only lengths are kept.

Other kinds of vocabulary do not promise such places.  Their texts go to the
library whole, still in batches balanced by bytes.

The merge loop of the ``tokenizers`` library takes four times as long for words
it has not met as that of ``tiktoken``.  Where the ids of a byte-level JSON
vocabulary are its merge ranks, both give the same tokens, so parts are
merged by ``tiktoken`` over the vocabulary read from the same file.  Each worker
first compares the two on a probe of its own data and stays with ``tokenizers``
if they ever differ; parts that hold a special string always go to
``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes handed to the library in one call, characters of a part, and parts on which a worker compares the libraries.
BATCH_BYTES, PART, PROBE = 1 << 18, 1 << 16, 40
_SAFE = re.compile(r"(?<=\S)(?= \S)")
#: How the byte-level pre-tokenizer cuts a text (fixed by the vocabulary's format).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def balanced(texts: Iterable[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        n = len(t) * 2
        if run and size + n > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += n
    if run:
        yield run


def _byte_of() -> dict[str, int]:
    """The printable stand-ins for bytes in a byte-level vocabulary, by the format's rule."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ranked:
    """The merge loop over a JSON vocabulary whose ids are merge ranks."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], _byte_of()
        special = {x["content"] for x in spec.get("added_tokens", [])}
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        ids = [model["vocab"][x] for x in joined]
        if ids != list(range(256, 256 + len(ids))) or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("ids are not merge ranks")
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        self.special = special
        self.encoding = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.encoding.encode_ordinary_batch(texts, num_threads=1)]


class Counter:
    """Counts the tokens of texts as the library that belongs to the vocabulary file does."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.ranked, self.probed, self.cuts = None, 0, False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda xs: [len(x) for x in model.encode(xs, num_threads=1)]
            return
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        encode = getattr(tok, "encode_batch_fast", tok.encode_batch)
        self.library = lambda xs: [len(x) for x in encode(xs, add_special_tokens=False)]
        kind = type(tok.pre_tokenizer).__name__
        self.cuts = kind == "ByteLevel" and not tok.pre_tokenizer.add_prefix_space and tok.normalizer is None
        if self.cuts:
            try:
                self.ranked = Ranked(path)
            except (KeyError, ValueError, TypeError):
                pass

    def parts(self, text: str) -> list[str]:
        """The text, cut at the first safe place after every PART characters if the vocabulary has safe places."""
        if not self.cuts or len(text) <= PART:
            return [text]
        out, at = [], 0
        while len(text) - at > PART:
            m = _SAFE.search(text, at + PART)
            if m is None:
                break
            out.append(text[at : m.start()])
            at = m.start()
        return [*out, text[at:]]

    def _plain(self, part: str) -> bool:
        return self.ranked is not None and not any(s in part for s in self.ranked.special)

    def lengths(self, parts: list[str]) -> list[int]:
        if self.probed < PROBE and (probe := [x for x in parts if self._plain(x)][: PROBE - self.probed]):
            self.probed += len(probe)
            if self.ranked.lengths(probe) != self.library(probe):
                self.ranked = None
        fast = [self._plain(x) for x in parts]
        a = iter(self.ranked.lengths([x for x, f in zip(parts, fast, strict=True) if f]) if any(fast) else [])
        b = iter(self.library([x for x, f in zip(parts, fast, strict=True) if not f]) if not all(fast) else [])
        return [next(a if f else b) for f in fast]

    def counts(self, texts: list[str]) -> np.ndarray:
        cut = [(i, p) for i, t in enumerate(texts) if t for p in self.parts(t)]
        got = [n for run in balanced(p for _, p in cut) for n in self.lengths(run)]
        return np.bincount([i for i, _ in cut], weights=got, minlength=len(texts)).astype(np.int64)


def vocabulary_path(tokenizer: str) -> str:
    """A path as it is; a bare file name by the installed package of vocabulary files."""
    if os.path.sep in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


@lru_cache(2)
def _counter(path: str) -> Counter:
    """One for all tasks of a worker process."""
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens.  Repeated rows and null ids
    stay, other columns of ``docs`` are not read.  An empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary_path(tokenizer))
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counter.counts(texts))], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
