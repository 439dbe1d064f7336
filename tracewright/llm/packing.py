"""Length buckets of least padding and batches of a token budget.

The histogram of lengths is a table of at most as many rows as there are lengths.
Dynamic programming over it picks the upper ends of the buckets: the cost of a
bucket is the padding of its texts up to the longest, which satisfies the
quadrangle inequality, so each layer is solved by divide and conquer.  Inside a
bucket texts are numbered by length and id through range-partitioned positions,
and runs of as many texts as fit the token budget at the bucket's length form
batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .token_counts import count_tokens

BUCKETS, BUDGET = 16, 65_536
#: A token of this packer is a run of characters other than white space.
_WORDS = r"[^\x20\x09-\x0D]+"


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending bucket ends (the last is the longest length) minimising total padding; fewer if fewer lengths exist."""
    n = len(lengths)
    if n == 0:
        return []
    size = np.concatenate(([0], np.cumsum(counts, dtype=np.float64)))
    mass = np.concatenate(([0.0], np.cumsum(counts.astype(np.float64) * lengths)))
    pad = lambda i, j: lengths[j - 1] * (size[j] - size[i]) - (mass[j] - mass[i])  # noqa: E731  # lengths i..j-1 in one bucket
    best = np.array([0.0] + [pad(0, j) for j in range(1, n + 1)])
    cuts = [np.zeros(n + 1, np.int64)]
    for layer in range(2, min(buckets, n) + 1):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        todo = [(layer, n, layer - 1, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid - 1) + 1)
            cost = best[i] + pad(i, mid)
            at = int(np.argmin(cost))
            new[mid], cut[mid] = cost[at], i[at]
            todo += [(lo, mid - 1, a, i[at]), (mid + 1, hi, i[at], b)]
        best = new
        cuts.append(cut)
    ends, j = [], n
    for cut in reversed(cuts):
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return ends[::-1]


def count_words(text):
    """Native expression for the length of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def pack(docs: DataFrame, lengths=None, tokenizer: str | None = None, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, bucket, bucket_len, batch, n_padding.

    ``lengths`` is a column of token counts; without it ``text`` is counted, with the
    vocabulary of ``tokenizer`` or, if there is none, in words.  Texts without tokens form bucket 0 of length 0, one batch.  A text longer than the
    budget has a batch of its own.  Null lengths count 0; rows with equal length
    and id are interchangeable; null ids come first among equals.  An empty table
    gives no row.
    """
    if lengths is None and tokenizer:
        rows = count_tokens(docs, tokenizer, id_col=id_col).select("doc_id", "n_tokens")
    else:
        n = F.coalesce(lengths, F.lit(0)).cast("long") if lengths is not None else count_words(F.col("text"))
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), n.alias("n_tokens"))
    rows = materialize(rows, "lengths")
    hist = sorted((r["n_tokens"], r["count"]) for r in rows.filter("n_tokens > 0").groupBy("n_tokens").count().toLocalIterator())
    ends = optimal_bounds(np.array([a for a, _ in hist], np.int64), np.array([b for _, b in hist], np.int64), buckets)
    table = F.array(*[F.lit(e).cast("long") for e in [0, *ends]])
    bucket = F.size(F.filter(table, lambda e: e < F.col("n_tokens")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("bucket", bucket.cast("int")).withColumn("bucket_len", F.element_at(table, F.col("bucket") + 1))
    placed = placed.repartitionByRange(parts, "n_tokens", "doc_id").withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "placed")
    sizes = placed.groupBy("bucket", "part").count()
    before = sizes.select("bucket", "part", (F.sum("count").over(Window.partitionBy("bucket").orderBy("part")) - F.col("count")).alias("before"))
    inside = placed.withColumn("within", F.row_number().over(Window.partitionBy("bucket", "part").orderBy("n_tokens", "doc_id")) - 1)
    room = F.when(F.col("bucket_len") > 0, F.greatest(F.floor(F.lit(budget) / F.col("bucket_len")), F.lit(1)))
    batch = F.coalesce(F.floor((F.col("within") + F.col("before")) / room), F.lit(0))
    return inside.join(before, ["bucket", "part"]).select("doc_id", "n_tokens", "bucket", "bucket_len", batch.cast("long").alias("batch"), (F.col("bucket_len") - F.col("n_tokens")).alias("n_padding"))
