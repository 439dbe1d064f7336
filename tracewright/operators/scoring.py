"""Importance of rows, incidents and their root causes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from ..sources.scratch import staged

POINT = ["final_score", "centrality_score", "temporal_proximity"]
#: Parts of a side of a cell, by whose boxes cells are linked.
PARTS = 8


def merge_scores(features: DataFrame, anomaly: DataFrame, graph: DataFrame) -> DataFrame:
    """Left joins on sequence_number with gaps filled: false, UNCAPPED, no ids, or the column's mean."""
    merged = features.join(anomaly, "sequence_number", "left").join(graph, "sequence_number", "left")
    added = [(c, t) for c, t in merged.dtypes if c not in features.columns]
    numbers = [c for c, t in added if t in ("double", "float", "int", "bigint")]
    means = F.broadcast(merged.agg(*[F.avg(c).alias(f"_mean_{c}") for c in numbers])) if numbers else None  # one row
    fill = {"boolean": F.lit(False), "string": F.lit("UNCAPPED"), "array<string>": F.array().cast("array<string>")}
    out = merged.crossJoin(means) if numbers else merged
    filled = [F.coalesce(F.col(c).cast("double"), f"_mean_{c}").alias(c) if c in numbers else F.coalesce(F.col(c), fill[t]).alias(c) for c, t in added]
    return out.select(*features.columns, *filled)


def missing_keys(features: DataFrame, other: DataFrame) -> DataFrame:
    return features.join(other, "sequence_number", "left_anti").agg(F.count(F.lit(1)).alias("missing"))


def temporal_proximity(rows: DataFrame) -> DataFrame:
    whole = Window.partitionBy("session_id")
    at = X.micros(F.col("timestamp")) / 1e6
    lo, hi = F.min(at).over(whole), F.max(at).over(whole)
    return rows.withColumn("temporal_proximity", (at - lo) / (hi - lo + 1e-10))


def importance(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """final_score and label from combined_score and centrality_score."""
    score = X.clip(config.ml_weight * F.col("combined_score") + config.graph_weight * F.col("centrality_score"), 0.0, 1.0)
    rows = temporal_proximity(rows).withColumn("final_score", score)
    return rows.withColumn("label", X.label_of(F.col("final_score"), config))


def dbscan(points: DataFrame, columns: list[str] | None = None, config: Config = DEFAULT) -> DataFrame:
    """(sequence_number, cluster): density clusters of min-max-scaled points, cluster null for noise.

    Space is cut into cells of side eps / sqrt(3), at most 6 x 6 x 6 of them.  All
    points of a cell with enough points are core and connected; other cells have
    few points.  So cells, not points, are joined: the boxes of points in the parts of
    a cell tell whether two cells are linked, and only parts that may hold the limit
    between them are compared by points.  Clusters are numbered by their
    first core point in row order; a border point takes the lowest number near it.
    """
    columns = columns or POINT
    points = staged(points.select("sequence_number", *columns), "points")
    eps, least = config.dbscan_eps, config.dbscan_min
    ends = points.agg(*[F.min(c).alias(f"_lo{i}") for i, c in enumerate(columns)], *[F.max(c).alias(f"_hi{i}") for i, c in enumerate(columns)])
    unit = [F.when(F.col(f"_hi{i}") > F.col(f"_lo{i}"), (F.col(c) - F.col(f"_lo{i}")) / (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).otherwise(0.0).alias(n) for i, (c, n) in enumerate(zip(columns, "xyz"))]
    unit += [F.lit(0.0).alias(n) for n in "xyz"[len(columns) :]]
    scaled = points.crossJoin(F.broadcast(ends)).select("sequence_number", *unit)  # one row
    side = eps / 3**0.5
    cell = F.concat_ws(",", *[F.floor(F.col(c) / side).cast("string") for c in "xyz"])
    placed = staged(scaled.withColumn("cell", cell), "placed")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("sequence_number").alias("first"))
    # Points of sparse cells need their neighbours; dense cells are core as a whole.
    reach = list(product(range(-2, 3), repeat=3))
    dense = {r["cell"]: (r["n"], r["first"]) for r in sizes.collect()}  # at most 6 ** 3 cells
    sparse = [c for c, (n, _) in dense.items() if n < least]

    def neighbours(c: str) -> list[str]:
        at = tuple(map(int, c.split(",")))
        return [",".join(str(a + b) for a, b in zip(at, r, strict=True)) for r in reach if any(r)]

    core_cells = [c for c, (n, _) in dense.items() if n >= least]
    spark = points.sparkSession
    few = placed.filter(F.col("cell").isin(sparse)) if sparse else None  # at most 4 points in each of 216 cells
    core = {}
    if sparse:
        pts = few.toPandas()
        xyz = pts[["x", "y", "z"]].to_numpy()
        near_counts = np.zeros(len(pts), int)
        # Distances from the few points to all rows, summed in the cluster: one aggregate per point.
        dist = lambda p: (F.sqrt(sum((F.col(c) - float(v)) ** 2 for c, v in zip("xyz", p, strict=True))) <= eps).cast("long")
        for lo in range(0, len(pts), 64):
            row = scaled.agg(*[F.sum(dist(p)).alias(f"c{i}") for i, p in enumerate(xyz[lo : lo + 64])]).first()
            near_counts[lo : lo + 64] = list(row)
        core = {int(s): near_counts[i] >= least for i, s in enumerate(pts["sequence_number"])}
    # Units: dense cells and single core points of sparse cells.
    units = [("c", c, dense[c][1]) for c in core_cells] + ([("p", i, int(pts["sequence_number"][i])) for i in range(len(pts)) if core[int(pts["sequence_number"][i])]] if sparse else [])
    root = list(range(len(units)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)

    number = {(k, v): i for i, (k, v, _) in enumerate(units)}
    wanted = [(a, b) for a in core_cells for b in neighbours(a) if b in dense and dense[b][0] >= least and a < b]
    for a, b in _linked(placed, wanted, eps, lambda a, b: find(number["c", a]) == find(number["c", b])):
        join(number["c", a], number["c", b])
    single = [(i, k, v) for i, (k, v, _) in enumerate(units) if k == "p"]
    near_cells: dict[int, set[str]] = {}
    if sparse and core_cells:
        for lo in range(0, len(pts), 64):
            agg = placed.filter(F.col("cell").isin(core_cells)).groupBy("cell").agg(*[F.max(dist(p)).alias(f"c{i}") for i, p in enumerate(xyz[lo : lo + 64])]).collect()
            for r in agg:
                for i in range(len(xyz[lo : lo + 64])):
                    if r[f"c{i}"]:
                        near_cells.setdefault(lo + i, set()).add(r["cell"])
    for i, _, v in single:
        for c in near_cells.get(v, ()):
            join(i, number["c", c])
        for j, _, w in single:
            if j > i and np.sqrt(((xyz[v] - xyz[w]) ** 2).sum()) <= eps:
                join(i, j)
    firsts: dict[int, int] = {}
    for i, (_, _, f) in enumerate(units):
        firsts[find(i)] = min(f, firsts.get(find(i), f))
    order = {r: k for k, r in enumerate(sorted(firsts, key=firsts.get))}
    by_cell = [(c, order[find(number["c", c])]) for c in core_cells]
    by_point = []
    if sparse:
        for i, s in enumerate(pts["sequence_number"]):
            if core[int(s)]:
                by_point.append((int(s), order[find(number["p", i])]))
                continue
            near = [order[find(number["c", c])] for c in near_cells.get(i, ())]
            near += [order[find(j)] for j, _, w in single if np.sqrt(((xyz[i] - xyz[w]) ** 2).sum()) <= eps]
            if near:
                by_point.append((int(s), min(near)))
    cells = F.broadcast(spark.createDataFrame(by_cell, "cell string, _cell_cluster int"))
    out = placed.join(cells, "cell", "left")
    points_ = F.broadcast(spark.createDataFrame(by_point, "sequence_number long, _own_cluster int"))  # at most 4 in each of 216 cells
    return out.join(points_, "sequence_number", "left").select("sequence_number", F.coalesce("_cell_cluster", "_own_cluster").alias("cluster"))


def _linked(placed: DataFrame, wanted: list[tuple[str, str]], eps: float, joined: Callable[[str, str], bool]) -> Iterator[tuple[str, str]]:
    """The pairs of dense cells with points within eps, but for those that ``joined`` knows to be connected.

    Cells are cut into PARTS ** 3 parts; per part one row with the box of its points
    and one of them comes to the driver.  Parts whose boxes leave it open are
    compared by points in the cluster, each two by one task.
    """
    if not wanted:
        return
    width = eps / 3**0.5 / PARTS
    part = F.concat_ws(",", *[F.floor(F.col(c) / width).cast("string") for c in "xyz"])
    ends = [f(c).alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in "xyz"]
    parts = placed.withColumn("part", part).filter(F.col("cell").isin(sorted({c for w in wanted for c in w})))
    one = F.min_by(F.struct("x", "y", "z"), "sequence_number").alias("one")
    rows = parts.groupBy("cell", "part").agg(*ends, one).select("cell", "part", *[f"{n}_{c}" for n in ("lo", "hi") for c in "xyz"], "one.*").toPandas()  # at most (PARTS + 1) ** 3 in each of 216 cells
    boxes = {c: (g["part"].to_numpy(), *(g[[f"{n}{c_}" for c_ in "xyz"]].to_numpy() for n in ("lo_", "hi_", ""))) for c, g in rows.groupby("cell")}
    apart = lambda w: sum(abs(int(p) - int(q)) for p, q in zip(w[0].split(","), w[1].split(","), strict=True))
    open_: list[tuple[str, str, np.ndarray, np.ndarray]] = []
    for a, b in sorted(wanted, key=apart):
        if joined(a, b):
            continue
        (names, lo, hi, at), (names2, lo2, hi2, at2) = boxes[a], boxes[b]
        lo, hi, at = lo[:, None], hi[:, None], at[:, None]
        if (((at - at2) ** 2).sum(2) <= eps * eps).any() or (np.maximum(hi2 - lo, hi - lo2) ** 2).sum(2).min() <= eps * eps * (1 - 1e-9):
            yield a, b
            continue
        i, j = np.nonzero((np.maximum(0.0, np.maximum(lo2 - hi, lo - hi2)) ** 2).sum(2) <= eps * eps * (1 + 1e-9))
        if len(i):
            open_.append((a, b, names[i], names2[j]))
    open_ = [(a, b, p, q) for a, b, p, q in open_ if not joined(a, b)]
    meet = [(f"{n}|{k}", c, x) for n, (a, b, p, q) in enumerate(open_) for k, xs in enumerate(zip(p, q, strict=True)) for c, x in zip((a, b), xs, strict=True)]
    if meet:
        group = placed.sparkSession.createDataFrame(meet, "pair string, cell string, part string")
        points = parts.select("cell", "part", "x", "y", "z").distinct().join(F.broadcast(group), ["cell", "part"])
        hits = points.groupBy("pair").applyInPandas(_closest(eps), "pair string, linked boolean").filter("linked").select(F.substring_index("pair", "|", 1).cast("int").alias("n")).distinct()
        yield from [open_[r["n"]][:2] for r in hits.collect()]


def _closest(eps: float):
    """Whether two dense cells have points within eps; blocks of the smaller side stop at the first hit."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [g[["x", "y", "z"]].to_numpy() for _, g in pdf.groupby("cell")]
        hit = any((((a[lo : lo + 256, None] - b[None, to : to + 4096]) ** 2).sum(2) <= eps * eps).any() for lo in range(0, len(a), 256) for to in range(0, len(b), 4096))
        return pd.DataFrame({"pair": [pdf["pair"].iloc[0]], "linked": [hit]})

    return run


def cluster_incidents(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """correlation_id (INC-0000, null for noise and ignored rows) and is_cross_system."""
    rows = staged(rows, "importance")
    found = staged(dbscan(rows.filter("label <> 'ignore'"), config=config), "clusters")
    named = rows.join(found, "sequence_number", "left").withColumn("correlation_id", F.when(F.col("cluster").isNotNull(), F.format_string("INC-%04d", F.col("cluster")))).drop("cluster")
    return cross_system(named)


def cross_system(rows: DataFrame) -> DataFrame:
    """is_cross_system: the incident touches more than one graph component."""
    wide = rows.filter("correlation_id is not null").groupBy("correlation_id").agg((F.count_distinct("cluster_id") > 1).alias("is_cross_system"))
    return rows.join(wide, "correlation_id", "left").withColumn("is_cross_system", F.coalesce("is_cross_system", F.lit(False)))


def root_causes(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(incident_id, sequence_number, root_cause_log_id, confidence_score, in_graph): up to three rows per incident.

    Rows in the graph go before all others of the incident; the rank is by
    centrality, the confidence relative to the best, or even where all are 0.
    """
    whole = Window.partitionBy("correlation_id")
    cand = rows.filter("correlation_id is not null").withColumn("_any", F.max("in_graph").over(whole)).filter(F.col("in_graph") | ~F.col("_any"))
    best = F.max("centrality_score").over(whole)
    conf = F.when(best > 0, F.col("centrality_score") / best).otherwise(1 / F.count(F.lit(1)).over(whole))
    turn = F.row_number().over(whole.orderBy(F.desc("centrality_score"), "sequence_number"))
    ranked = cand.withColumns({"confidence_score": conf, "_turn": turn}).filter(F.col("_turn") <= config.root_causes)
    return ranked.select(F.col("correlation_id").alias("incident_id"), "sequence_number", F.format_string("log_%06d", F.col("sequence_number")).alias("root_cause_log_id"), "confidence_score", "in_graph")


def scored_logs(rows: DataFrame, causes: DataFrame) -> DataFrame:
    """The contract of the scoring stage: 7 columns."""
    marks = causes.select("sequence_number", F.lit(True).alias("_root"), F.col("confidence_score").alias("_conf"))
    return rows.join(marks, "sequence_number", "left").select(
        "sequence_number", "final_score", "label", "correlation_id", F.coalesce("_root", F.lit(False)).alias("is_root_cause"), F.coalesce("_conf", F.lit(0.0)).alias("root_cause_confidence"), "is_cross_system"
    )
