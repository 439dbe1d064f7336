"""Connected components of an edge table by randomised contraction.

Each round every vertex moves to the neighbour (or itself) that comes first in a
hash order drawn for the round, edges are renamed and deduplicated, and loops go.
In expectation a constant share of the vertices disappears per round whatever the
shape of the graph, so long paths and stars with a hot centre both take a
logarithmic number of rounds.  Each round is written to the shared folder.  Once
at most ``finish`` edges are left, one task finishes them by union-find; that
bound does not move with the input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

FINISH_EDGES = 400_000


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its component) for the edges u-v, vectorised."""
    ids, inv = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inv[: len(u)], inv[len(u) :]
    root = np.arange(len(ids))
    while True:
        ra, rb = root[a], root[b]
        lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
        if (lo == hi).all():
            return ids, ids[root]
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _finish(pdf: pd.DataFrame) -> pd.DataFrame:
    ids, root = spanning(pdf["u"].to_numpy(), pdf["v"].to_numpy())
    return pd.DataFrame({"u": ids, "root": root})


def connected_components(edges: DataFrame, finish: int = FINISH_EDGES) -> DataFrame:
    """(u, root) for every vertex on an edge; root is the smallest vertex reachable.

    ``edges`` has long columns u and v, loops and repeats allowed; rows with a
    null end are ignored.  No edge gives no row.
    """
    e = edges.filter("u is not null and v is not null and u <> v")
    e = materialize(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    moves: list[DataFrame] = []
    rounds = 0
    while e.count() > finish:
        rounds += 1
        both = e.union(e.select("v", "u"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(rounds), c).alias("h"), c.alias("to"))
        best = both.groupBy("u").agg(F.min(rank(F.col("v"))).alias("b"))
        move = best.select("u", F.least(F.col("b"), rank(F.col("u")))["to"].alias("to"))
        move = materialize(move, "moves")
        moves.append(move)
        left, right = move.select("u", F.col("to").alias("a")), move.select(F.col("u").alias("v"), F.col("to").alias("b"))
        e = e.join(left, "u").join(right, "v").filter("a <> b")
        e = materialize(e.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    done = e.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_finish, "u long, root long")
    if not moves:
        return done
    # Undo the renaming from the last round to the first; a vertex without an edge left is its own root.
    names = done
    for move in reversed(moves):
        known = names.select(F.col("u").alias("to"), "root")
        names = materialize(move.join(known, "to", "left").select("u", F.coalesce("root", "to").alias("root")), "names")
    least = names.groupBy("root").agg(F.min("u").alias("least"))
    return names.join(least, "root").select("u", F.col("least").alias("root"))
