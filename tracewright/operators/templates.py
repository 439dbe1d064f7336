"""Template mining and template statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from ..sources.scratch import staged

_WILD, EMPTY = "<*>", "EMPTY"
#: What stands between the tokens of a message in a string (no token holds white space); characters of messages whose cluster is remembered.
GLUE, HELD = "\n", 1 << 24
_FOUND = ["sequence_number", "_n", "_first", "_cluster", "template"]


class _Bucket:
    """Clusters of the messages of one bucket, that come in order: each joins the first most similar one, or opens its own."""

    def __init__(self, n: int, threshold: float, most: int):
        self.n, self.threshold, self.most = n, threshold, most
        self.words: list[list[str]] = []
        self.first: list[int] = []
        self.codes = {_WILD: 0}
        self.grid = np.zeros((4, n), np.int32)
        self.known: dict[str, int] = {}
        self.held = 0

    def add(self, text: str, number: int) -> int:
        """The message's cluster; -1 in a full bucket for one that joins none and that none can join."""
        at = self.known.get(text)
        if at is None:
            at = self._place(text.split(GLUE), number)
            self.held += len(text)
            if self.held > HELD:
                self.known, self.held = {}, len(text)
            self.known[text] = at  # until a cluster changes, equal messages go the same way
        return at

    def _place(self, words: list[str], number: int) -> int:
        k = len(self.words)
        own = np.fromiter((self.codes.get(w, -1) for w in words), np.int32, self.n)
        if k:
            hits = ((self.grid[:k] == own) | (self.grid[:k] == 0)).sum(1)
            best = int(hits.argmax())
            if hits[best] / self.n >= self.threshold:
                if hits[best] < self.n:
                    self.words[best] = [a if a == b else _WILD for a, b in zip(self.words[best], words, strict=True)]
                    self.grid[best] = np.where(self.grid[best] == own, own, 0)
                    self.known, self.held = {}, 0
                return best
        if k >= self.most:
            return -1
        if k == len(self.grid):
            self.grid = np.concatenate([self.grid, np.zeros_like(self.grid)])
        self.grid[k] = [self.codes.setdefault(w, len(self.codes)) for w in words]
        self.words.append(words)
        self.first.append(number)
        return k


def _fold(threshold: float, most: int):
    """Rows sorted by bucket and number, one bucket's clusters in memory: a row per message, and one per cluster with its template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bucket = None, None

        def pack(number, n, first, cluster, template) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(n, pa.int32()), pa.array(first, pa.string()), pa.array(cluster, pa.int32()), pa.array(template, pa.string())], names=_FOUND)

        def heads() -> pa.RecordBatch:
            k = len(bucket.words)
            return pack(bucket.first, [key[0]] * k, [key[1]] * k, range(k), [" ".join(w) for w in bucket.words])

        for b in batches:
            number, n, first, text = (c.to_pylist() for c in b.columns)
            owner = []
            for now, x, i in zip(zip(n, first, strict=True), text, number, strict=True):
                if now != key:
                    if bucket:
                        yield heads()
                    key, bucket = now, _Bucket(now[0], threshold, most)
                owner.append(bucket.add(x, i))
            yield pack(b.column(0), b.column(1), b.column(2), owner, [x.replace(GLUE, " ") if o < 0 else None for o, x in zip(owner, text, strict=True)])
        if bucket:
            yield heads()

    return run


def mine_templates(rows: DataFrame, config: Config = DEFAULT, message: str = "message") -> DataFrame:
    """``rows`` with template and template_id.

    Clusters never leave the bucket of their token count and first token, so each
    bucket is folded in row order by itself and the result is that of one pass.
    Names come from the final templates; of templates with one name the first
    keeps it and the others get a digest.  Empty messages share one template.
    """
    words = X.tokens(F.col(message))
    filled = rows.filter(F.coalesce(F.trim(message), F.lit("")) != "").select("sequence_number", words.alias("_tokens"))
    keyed = filled.select("sequence_number", F.size("_tokens").alias("_n"), F.element_at("_tokens", 1).alias("_first"), F.array_join("_tokens", GLUE).alias("_text"))
    ordered = keyed.repartition("_n", "_first").sortWithinPartitions("_n", "_first", F.asc_nulls_last("sequence_number"))
    found = staged(ordered.mapInArrow(_fold(config.sim_threshold, config.max_children), "sequence_number long, _n int, _first string, _cluster int, template string"), "folded")
    heads = found.filter("template is not null")
    slugs = heads.groupBy("template").agg(F.min("sequence_number").alias("first")).withColumn("base", X.template_slug(F.split("template", " ")))
    turn = F.row_number().over(Window.partitionBy("base").orderBy("first", "template"))
    named = slugs.select("template", F.when(turn == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.left(F.md5("template"), F.lit(4)))).alias("template_id"))
    named = staged(heads.join(named, "template"), "templates")
    key = ["_n", "_first", "_cluster"]
    joined = found.filter("template is null").select("sequence_number", *key).join(named.filter("_cluster >= 0").select(*key, "template", "template_id"), key)
    ids = joined.select("sequence_number", "template", "template_id").union(named.filter("_cluster < 0").select("sequence_number", "template", "template_id"))
    return rows.join(ids, "sequence_number", "left").withColumns({"template_id": F.coalesce("template_id", F.lit(EMPTY)), "template": F.coalesce("template", F.lit(""))})


def template_stats(rows: DataFrame) -> DataFrame:
    """Per template: rows, share in percent, commonest level (the smallest on a tie)."""
    total = F.sum("count").over(Window.partitionBy())
    stats = rows.groupBy("template_id").agg(F.count(F.lit(1)).alias("count"), F.mode(F.col("log_level"), True).alias("top_log_level"))
    return stats.withColumn("pct", F.round(100 * F.col("count") / total, 2)).orderBy(F.desc("count"), "template_id")


def template_list(rows: DataFrame) -> DataFrame:
    """(template_id, template, count) of all templates, the commonest first."""
    return rows.groupBy("template_id").agg(F.min("template").alias("template"), F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "template_id")


def template_warning(n_templates: int) -> str | None:
    """A hint when the number of templates looks too small or too large."""
    return "too coarse" if n_templates < 5 else "too granular" if n_templates > 200 else None
