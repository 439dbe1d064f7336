"""Nearest neighbours along several shifted space-filling curves.

Vectors are projected on random directions that lean towards those in which the
data vary, each projection is replaced by its rank in a bounded sample, shifted,
and the points are ordered by Hilbert keys, one ordering per curve.  Spark
range-partitions the keys and numbers the rows.  A query looks at all rows whose
number lies within a window of its own on any curve; blocks of the window are
searched apart, the results are merged and reranked by exact Euclidean distance.

The number of curves and the width of the window are measured, not set: for a
bounded sample of queries the true neighbours are found by a pass over all rows,
and the window of the first c curves is the rank distance within which the target
share of them lies on one of these; the c with the least rows to look at is taken.
So the work follows the data at every size: windows are narrow where vectors form
clusters, and wide where they are spread evenly in many dimensions, which no
ordering of a line can follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: ``LEAST`` is the narrowest window, against chance in the sample; ``SAMPLE`` vectors give directions and ranks.
CURVES, AXES, BITS, PROBES, TARGET, LEAST, SAMPLE = 8, 4, 8, 64, 0.97, 32, 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (one row each, ``bits`` bits per axis)."""
    x = [c.astype(np.uint64) for c in cells.T]
    n, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):  # undo the rotations and reflections of each level
        low = np.uint64((1 << b) - 1)
        for i in range(n):
            set_ = (x[i] >> np.uint64(b)) & one == 1
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> np.uint64(b)) & one == 1, turn ^ np.uint64((1 << b) - 1), turn)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = key << one | (v ^ turn) >> np.uint64(b) & one
    return key


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec as doubles) of the rows that take part: the commonest length, all finite, not all zero."""
    vec = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter("vec_id is not null and vec is not null and size(vec) > 0")
    top = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return rows.filter((F.size("vec") == (top["d"] if top else 0)) & F.coalesce(fine, F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def distances(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; components are scaled where squares would overflow or vanish."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = x - query
        square = (gap * gap).sum(1)
        out = np.sqrt(square)
        for i in np.flatnonzero(~(square < np.inf) | (square < 1e-290)):
            half = x[i] / 2 - query / 2  # no overflow
            most = np.abs(half).max()
            out[i] = 2 * most * np.sqrt(((half / most) ** 2).sum()) if most > 0 else 0.0
    return out


def best(ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest different ids, each at its smallest distance, ties to the smaller id."""
    order = np.lexsort((ids, d))
    ids, d = ids[order], d[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], d[first]


def nearest(ids: np.ndarray, x: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest different ids and their distances, ties to the smaller id.  Products pre-select, exact distances decide."""
    far = np.flatnonzero(ids != own)
    ids, x = ids[far], x[far]
    with np.errstate(over="ignore", invalid="ignore"):
        rough = (x * x).sum(1) - 2 * (x @ query) if len(x) else np.zeros(0)
        slack = 1e-9 * ((query * query).sum() + 1)
    many = k
    while True:
        at = np.arange(len(ids))
        if len(ids) > 4 * many and np.isfinite(rough).all() and np.isfinite(slack):
            edge = np.partition(rough, many - 1)[many - 1]
            at = np.flatnonzero(rough <= edge + 1e-9 * abs(edge) + slack)
        got = best(ids[at], distances(x[at], query), k)
        if len(got[0]) >= k or len(at) == len(ids):  # else ids repeat among the nearest rows
            return got
        many *= 4


def _projection(vecs: DataFrame, curves: int, axes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(directions, sorted projections of a bounded sample, shifts, scale) of each curve and axis."""
    some = matrix(vecs.orderBy(F.xxhash64(F.lit(seed), "row")).limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks())
    scale = float(np.median(np.abs(some).max(1))) or 1.0
    some = np.nan_to_num(some / scale, posinf=1e150, neginf=-1e150).clip(-1e6, 1e6)
    value, vector = np.linalg.eigh(np.cov(some.T, bias=True).reshape(some.shape[1], -1))
    lean = vector * np.sqrt(np.maximum(value, 1e-12 * max(value.max(), 1e-300)))
    axes = min(axes, some.shape[1])
    rng = np.random.default_rng(seed)
    bases = np.stack([np.linalg.qr(lean @ rng.normal(size=(some.shape[1], axes)))[0] for _ in range(curves)])
    return bases, np.sort(np.einsum("nd,cda->can", some, bases), axis=2), rng.random((curves, axes)), scale


def _orders(vecs: DataFrame, curves: int, axes: int, bits: int, seed: int) -> DataFrame:
    """(curve, row, rank): the number of each row along each curve, from 0."""
    bases, ranks, shifts, scale = _projection(vecs, curves, axes, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.nan_to_num(matrix(b.column(1)) / scale, posinf=1e150, neginf=-1e150).clip(-1e6, 1e6)
            for c in range(curves):
                p = x @ bases[c]
                u = np.stack([np.searchsorted(r, p[:, i]) for i, r in enumerate(ranks[c])], 1) / (ranks.shape[2] + 1)
                key = hilbert_keys(((u + shifts[c]) / 2 * (1 << bits)).astype(np.int64), bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(key.astype(np.int64)), b.column(0)], ["curve", "key", "row"])

    keys = vecs.select("row", "vec").mapInArrow(run, "curve int, key long, row long")
    n = vecs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = keys.repartitionByRange(int(n), "curve", "key", "row").withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "curves")
    # Numbers within a part, then what lies before the part on its curve; a table of parts, not of rows.
    sizes = placed.groupBy("curve", "part").count()
    before = sizes.select("curve", "part", (F.sum("count").over(Window.partitionBy("curve").orderBy("part")) - F.col("count")).alias("before"))
    inside = placed.withColumn("within", F.row_number().over(Window.partitionBy("curve", "part").orderBy("key", "row")) - 1)
    return materialize(inside.join(before, ["curve", "part"]).select("curve", "row", (F.col("within") + F.col("before")).alias("rank")), "ranks")


def brute_force(vecs: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> list[tuple[int, int, float]]:
    """(query, vec_id, distance) by a pass over all rows, for a bounded list of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            ids, x = b.column(0).to_numpy(), matrix(b.column(1))
            for q, v in queries:
                i, d = nearest(ids, x, np.array(v, float), q, k)
                held[q] = best(np.concatenate([held[q][0], i]), np.concatenate([held[q][1], d]), k) if q in held else (i, d)
        for q, (i, d) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), q)), pa.array(i), pa.array(d)], ["query_id", "vec_id", "score"])

    rows = vecs.select("vec_id", "vec").mapInArrow(run, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    top = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
    return [(r["query_id"], r["vec_id"], r["score"]) for r in top.collect()]


def plan_of(gaps: np.ndarray, target: float) -> tuple[int, int]:
    """(curves, window) with the least rows to look at, from the gaps of true pairs (rows) on each curve (columns)."""
    plans = []
    for c in range(1, gaps.shape[1] + 1):
        wide = max(LEAST, int(np.ceil(np.quantile(gaps[:, :c].min(1), target, method="higher"))))
        plans.append((c * (2 * wide + 1), c, wide))
    return min(plans)[1:]


def _measured(vecs: DataFrame, orders: DataFrame, queries: DataFrame, k: int, curves: int, probes: int, target: float) -> tuple[int, int]:
    """(curves, window) by which ``target`` of the true neighbours of a bounded sample of queries are found."""
    some = [(r["vec_id"], r["row"], r["vec"]) for r in queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(probes).collect()]
    true = brute_force(vecs, [(q, v) for q, _, v in some], k)
    if not true:
        return 1, LEAST
    spark = vecs.sparkSession
    pairs = F.broadcast(spark.createDataFrame([(q, v) for q, v, _ in true], "query_id long, vec_id long"))  # probes x k rows
    there = vecs.select("vec_id", "row").join(pairs, "vec_id").join(orders, "row").select("query_id", "vec_id", "curve", F.col("rank").alias("there"))
    asked = F.broadcast(spark.createDataFrame([(q, r) for q, r, _ in some], "query_id long, row long"))
    here = orders.join(asked, "row").select("query_id", "curve", F.col("rank").alias("here"))
    rows = there.join(here, ["query_id", "curve"]).groupBy("query_id", "vec_id", "curve").agg(F.min(F.abs(F.col("there") - F.col("here"))).alias("gap")).collect()
    at = {p: i for i, p in enumerate(sorted({(r["query_id"], r["vec_id"]) for r in rows}))}
    gaps = np.zeros((len(at), curves))
    for r in rows:
        gaps[at[r["query_id"], r["vec_id"]], r["curve"]] = r["gap"]
    return plan_of(gaps, target)


def search(vectors: DataFrame, k: int = 10, every: int = 100, curves: int = CURVES, axes: int = AXES, bits: int = BITS, probes: int = PROBES, target: float = TARGET, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows with vec_id divisible by ``every`` their k nearest others found.

    Score is the Euclidean distance of the original vectors in double precision;
    ties go to the smaller vec_id.  Vectors that are null, zero, of an odd length
    or not finite take no part.  Rows that repeat a vec_id count as one candidate,
    at their smallest distance, and are not candidates of a query of that id; the
    query is the smallest of their vectors.  An empty table gives no row.
    """
    spark = vectors.sparkSession
    vecs = materialize(valid_vectors(vectors).dropDuplicates(["vec_id", "vec"]).withColumn("row", F.monotonically_increasing_id()), "vectors")
    chosen = vecs.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("vec", "row")).alias("q")).select("vec_id", "q.row", "q.vec")
    kind = "query_id long, rank int, vec_id long, score double"
    if chosen.isEmpty():
        return spark.createDataFrame([], kind)
    orders = _orders(vecs, curves, axes, bits, seed)
    used, wide = _measured(vecs, orders, chosen, k, curves, probes, target)
    orders = orders.filter(F.col("curve") < used)
    block = int(min(65_536, max(256, wide // 4)))
    rows = orders.join(vecs, "row").select("curve", F.floor(F.col("rank") / block).alias("block"), "vec_id", "rank", "vec")
    asks = orders.join(chosen, "row").select("curve", "vec_id", "rank", "vec")
    first, last = F.floor(F.greatest(F.col("rank") - wide, F.lit(0)) / block), F.floor((F.col("rank") + wide) / block)
    asks = asks.select("curve", F.explode(F.sequence(first, last)).alias("block"), "vec_id", "rank", "vec")

    def run(found: pa.Table, asked: pa.Table) -> pa.Table:
        found, asked = found.combine_chunks(), asked.combine_chunks()
        out: list[tuple] = []
        if len(found) and len(asked):
            col = lambda t, c: t.column(c).combine_chunks()
            ids, ranks, x = col(found, "vec_id").to_numpy(), col(found, "rank").to_numpy(), matrix(col(found, "vec"))
            order = np.argsort(ranks, kind="stable")
            ids, ranks, x = ids[order], ranks[order], x[order]
            for q, r, v in zip(col(asked, "vec_id").to_pylist(), col(asked, "rank").to_pylist(), matrix(col(asked, "vec")), strict=True):
                lo, hi = np.searchsorted(ranks, [r - wide, r + wide + 1])
                i, d = nearest(ids[lo:hi], x[lo:hi], v, q, k)
                out += zip([q] * len(i), i.tolist(), d.tolist(), strict=True)
        c = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.float64())], ["query_id", "vec_id", "score"])

    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  # both come from one table
    rows, asks = fresh(rows), fresh(asks)
    found = rows.groupBy("curve", "block").cogroup(asks.groupBy("curve", "block")).applyInArrow(run, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
