"""Template co-occurrence: edges, components, centrality, sequences."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from ..sources import files
from ..sources.scratch import staged

NODE_SCORES = "template_id string, component string, pagerank double, betweenness double, degree long"


def all_templates(rows: DataFrame) -> DataFrame:
    """(template_id, frequency) of every template, with its summed frequency."""
    return rows.groupBy("template_id").agg(F.sum("frequency").cast("long").alias("frequency"))


def top_templates(rows: DataFrame, n: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """(template_id, frequency) of the n templates with the largest summed frequency."""
    return all_templates(rows).orderBy(F.desc("frequency"), "template_id").limit(n or config.graph_max_nodes)


def session_pairs(rows: DataFrame, nodes: DataFrame, window_s: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """(session_id, a, b): template pairs at most the window apart in a session, a < b, each once.

    Rows become one per session, slot of the window's length and template, with its
    first and last time.  Two templates of a slot are within the window; of two
    slots in a row the last of one and the first of the other tell.
    """
    wide = (window_s or config.graph_window_s) * 1_000_000
    kept = rows.join(nodes.select("template_id"), "template_id", "left_semi")
    at = X.micros(F.col("timestamp"))
    seen = kept.groupBy("session_id", F.floor(at / wide).alias("slot"), "template_id").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    first = seen.select("session_id", F.col("template_id").alias("x"), "hi", F.explode(F.array(F.lit(0), F.lit(1))).alias("on"), "slot")
    first = first.select("session_id", "x", "hi", (F.col("slot") + F.col("on")).alias("slot"), "on")
    second = seen.select("session_id", F.col("template_id").alias("y"), "lo", "slot")
    near = F.when(F.col("on") == 0, F.col("x") < F.col("y")).otherwise((F.col("x") != F.col("y")) & (F.col("lo") - F.col("hi") <= wide))
    met = first.join(second, ["session_id", "slot"]).filter(near)
    return met.select("session_id", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def edges(rows: DataFrame, nodes: DataFrame, window_s: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """(a, b, cooccurrence_count, weight, pmi): weight is the share of all sessions, pmi is not below 0."""
    pairs = session_pairs(rows, nodes, window_s, config).groupBy("a", "b").agg(F.count(F.lit(1)).alias("cooccurrence_count"))
    total = F.broadcast(rows.agg(F.count_distinct("session_id").alias("_n")))  # one row
    of = F.col("frequency").cast("double")  # products of frequencies exceed a long
    fa = nodes.select(F.col("template_id").alias("a"), of.alias("_fa"))
    fb = nodes.select(F.col("template_id").alias("b"), of.alias("_fb"))
    c = F.col("cooccurrence_count")
    pmi = F.greatest(F.lit(0.0), F.log(c * F.col("_n") / (F.col("_fa") * F.col("_fb")) + 1e-10))
    return pairs.join(fa, "a").join(fb, "b").crossJoin(total).select("a", "b", "cooccurrence_count", (c / F.col("_n")).alias("weight"), pmi.alias("pmi"))


def components(nodes: list[str], pairs: list[tuple[str, str]]) -> dict[str, str]:
    """Component names by size, ties by their first template."""
    root = {n: n for n in nodes}

    def find(x: str) -> str:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    groups: dict[str, list[str]] = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    ranked = sorted(groups.values(), key=lambda g: (-len(g), min(g)))
    return {n: f"C{i:04d}" for i, g in enumerate(ranked) for n in g}


@dataclass
class Links:
    """A symmetric graph by rows: the links of node i stand from start[i] to start[i + 1]."""

    start: np.ndarray
    to: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> Links:
        """From links that stand once each; those of weight 0 are none."""
        a, b, weight = a[weight != 0], b[weight != 0], weight[weight != 0]
        at, to = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.lexsort((to, at))
        return cls(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]), to[order], np.concatenate([weight, weight])[order])

    @classmethod
    def dense(cls, w: np.ndarray) -> Links:
        a, b = np.nonzero(np.triu(w))
        return cls.of(len(w), a, b, w[a, b])

    def __len__(self) -> int:
        return len(self.start) - 1


def pagerank(w: Links | np.ndarray, alpha: float, rounds: int = 100) -> np.ndarray:
    """Power iteration over symmetric weights; nodes without edges spread evenly."""
    w = w if isinstance(w, Links) else Links.dense(w)
    n = len(w)
    at = np.repeat(np.arange(n), np.diff(w.start))
    out = np.bincount(at, w.weight, n)
    p = np.full(n, 1 / n)
    for _ in range(rounds):
        share = np.where(out > 0, p / np.where(out > 0, out, 1), 0)
        p = alpha * (np.bincount(w.to, share[at] * w.weight, n) + p[out == 0].sum() / n) + (1 - alpha) / n
    return p


def betweenness(w: Links | np.ndarray, sources: np.ndarray) -> np.ndarray:
    """Shortest-path betweenness with weights as distances, from the given sources, normalised and scaled to all."""
    w = w if isinstance(w, Links) else Links.dense(w)
    n = len(w)
    total = np.zeros(n)
    for s in sources:
        dist, paths, before, order = np.full(n, np.inf), np.zeros(n), [[] for _ in range(n)], []
        dist[s], paths[s] = 0, 1
        heap, done = [(0.0, int(s))], np.zeros(n, bool)
        while heap:
            d, v = heapq.heappop(heap)
            if done[v]:
                continue
            done[v] = True
            order.append(v)
            here = slice(w.start[v], w.start[v + 1])
            for u, far in zip(w.to[here].tolist(), w.weight[here].tolist(), strict=True):
                new = d + far
                if new < dist[u] - 1e-12:
                    dist[u], paths[u], before[u] = new, paths[v], [v]
                    heapq.heappush(heap, (new, u))
                elif abs(new - dist[u]) <= 1e-12 and not done[u]:
                    paths[u] += paths[v]
                    before[u].append(v)
        back = np.zeros(n)
        for v in reversed(order):
            for u in before[v]:
                back[u] += paths[u] / paths[v] * (1 + back[v])
            if v != s:
                total[v] += back[v]
    if n <= 2 or not len(sources):
        return total
    return total * n / len(sources) / ((n - 1) * (n - 2))


def scaled(x: np.ndarray, flat: float = 0.5) -> np.ndarray:
    lo, hi = x.min(), x.max()
    return np.full(len(x), flat) if hi - lo < 1e-15 else (x - lo) / (hi - lo)


def node_scores(nodes: DataFrame, links: DataFrame, config: Config = DEFAULT, flat: float = 0.5) -> DataFrame:
    """Per node: component, scaled pagerank (``flat`` where all are equal), betweenness, degree.

    One task holds the graph of templates, in memory that follows nodes and links.
    """

    def run(t: pa.Table) -> pa.Table:
        alone = pc.is_null(t["b"])
        names = np.array(sorted(t.filter(pc.and_(alone, pc.is_valid(t["a"])))["a"].to_pylist()), object)
        e = t.filter(pc.invert(alone))
        ids = pa.array(names, pa.string())
        a, b = (pc.index_in(e[c], ids).to_numpy() for c in ("a", "b"))
        n = len(names)
        w = Links.of(n, a, b, e["weight"].to_numpy())
        k = min(config.betweenness_pivots, n)
        sources = np.arange(n) if k == n else np.random.default_rng(config.seed).choice(n, k, replace=False)
        between = betweenness(w, sources)
        if n and np.ptp(between) < 1e-15:
            between = np.full(n, 0.5)
        group = components(names.tolist(), list(zip(names[a].tolist(), names[b].tolist(), strict=True)))
        ranks = scaled(pagerank(w, config.pagerank_alpha), flat) if n else np.zeros(0)
        return pa.table({"template_id": ids, "component": pa.array([group[i] for i in names], pa.string()), "pagerank": pa.array(ranks), "betweenness": pa.array(between), "degree": pa.array(np.diff(w.start).astype(np.int64))})

    none = F.lit(None)
    both = nodes.select(F.col("template_id").alias("a"), none.cast("string").alias("b"), none.cast("double").alias("weight")).union(links.select("a", "b", "weight"))
    return both.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(lambda t: run(t), NODE_SCORES)


def sequence_rows(rows: DataFrame, window_s: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """(session_id, sequence, ids): runs of consecutive templates within the window, the first of each kind per session."""
    wide, n = (window_s or config.sequence_window_s) * 1_000_000, config.sequence_length
    order = Window.partitionBy("session_id").orderBy("_us", "sequence_number")
    base = rows.select("session_id", "sequence_number", "template_id", X.micros(F.col("timestamp")).alias("_us"))
    ahead = [(F.lead("template_id", i).over(order), F.lead("sequence_number", i).over(order)) for i in range(1, n)]
    grams = base.select(
        "session_id", "sequence_number", "_us", (F.lead("_us", n - 1).over(order) - F.col("_us")).alias("_span"),
        F.array("template_id", *[t for t, _ in ahead]).alias("sequence"), F.array("sequence_number", *[s for _, s in ahead]).alias("ids"),
    ).filter(F.col("_span") <= wide)
    first = F.row_number().over(Window.partitionBy("session_id", "sequence").orderBy("_us", "sequence_number"))
    return grams.withColumn("_turn", first).filter("_turn = 1").select("session_id", "sequence", "ids")


def sequences(rows: DataFrame, window_s: int | None = None, support: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """(sequence, support_count, session_ids) of sequences found in enough sessions."""
    found = sequence_rows(rows, window_s, config).groupBy("sequence").agg(F.count(F.lit(1)).alias("support_count"), F.sort_array(F.collect_set("session_id")).alias("session_ids"))
    return found.filter(F.col("support_count") >= (support or config.sequence_support))


def in_sequence(rows: DataFrame, window_s: int | None = None, support: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """(sequence_number): rows that are part of a retained sequence."""
    own = sequence_rows(rows, window_s, config)
    kept = own.groupBy("sequence").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= (support or config.sequence_support))
    return own.join(kept, "sequence", "left_semi").select(F.explode("ids").alias("sequence_number")).distinct()


def correlated_ids(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(session_id, template_id, correlated_log_ids): row ids of neighbouring templates in the session, ascending."""
    near = links.select(F.col("a").alias("template_id"), F.col("b").alias("near")).union(links.select("b", "a"))
    have = rows.select("session_id", "template_id").distinct()
    asked = have.join(near, "template_id")  # Spark broadcasts the edges if they are few
    ids = rows.groupBy("session_id", F.col("template_id").alias("near")).agg(F.collect_list("sequence_number").alias("ids"))
    met = asked.join(ids, ["session_id", "near"]).groupBy("session_id", "template_id").agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))
    return met.select("session_id", "template_id", F.transform("ids", lambda i: i.cast("string")).alias("correlated_log_ids"))


def graph_scores(rows: DataFrame, window_s: int | None = None, sequence_window_s: int | None = None, support: int | None = None, config: Config = DEFAULT, ids: Callable[[Column], Column] | None = None, flat: float = 0.5) -> DataFrame:
    """The contract of the correlation stage: 8 columns per row.  Every template is in the graph;
    rows without one get its means.

    Rows, nodes, edges and scores are written once each; every branch reads these.
    ``ids`` is applied to correlated_log_ids once per session and template, before rows take them.
    """
    rows = staged(rows.select("sequence_number", "session_id", "template_id", "timestamp", "frequency"), "graph-rows")
    nodes = staged(all_templates(rows), "graph-nodes")
    links = staged(edges(rows, nodes, window_s, config), "graph-edges")
    scores = staged(node_scores(nodes, links, config, flat), "graph-scores")
    p, b = scores.agg(F.coalesce(F.avg("pagerank"), F.lit(0.5)), F.coalesce(F.avg("betweenness"), F.lit(0.5))).first()
    marked = in_sequence(rows, sequence_window_s, support, config).withColumn("_seq", F.lit(True))
    out = rows.join(scores, "template_id", "left").join(marked, "sequence_number", "left")
    own = ids or (lambda c: c)
    near = correlated_ids(rows, links).withColumn("correlated_log_ids", own(F.col("correlated_log_ids")))
    out = out.join(staged(near, "graph-ids") if ids else near, ["session_id", "template_id"], "left")
    return out.select(
        "sequence_number", F.coalesce("pagerank", F.lit(p)).alias("centrality_score"), F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("betweenness", F.lit(b)).alias("betweenness"),
        F.col("pagerank").isNotNull().alias("in_graph"), F.coalesce("component", F.lit("UNCAPPED")).alias("cluster_id"), F.coalesce("_seq", F.lit(False)).alias("in_sequence"),
        F.coalesce("correlated_log_ids", own(F.array().cast("array<string>"))).alias("correlated_log_ids"),
    )


def fingerprint(rows: DataFrame) -> str:
    """A digest of what a graph is made from: the count and a sum of hashes, whatever the order of rows."""
    h = F.xxhash64("session_id", "template_id", "timestamp", "frequency").cast("decimal(38,0)")
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h"), F.count_distinct("session_id").alias("s")).first()
    return f"{r['n']}-{r['h'] or 0}-{r['s']}"


def cached_graph(rows: DataFrame, folder: str, window_s: int | None = None, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) from ``folder`` if they were made from equal rows and settings, else built and written there."""
    spark = rows.sparkSession
    mark = f"{fingerprint(rows)}-{window_s or config.graph_window_s}-{config.graph_max_nodes}"
    try:
        fresh = files.read_text(spark, f"{folder}/fingerprint") == mark
    except FileNotFoundError:
        fresh = False
    if not fresh:
        files.delete(spark, f"{folder}/fingerprint")
        rows = staged(rows.select("session_id", "template_id", "timestamp", "frequency"), "graph-rows")
        nodes = staged(top_templates(rows, config=config), "graph-nodes")
        nodes.write.mode("overwrite").parquet(f"{folder}/nodes")
        edges(rows, nodes, window_s, config).write.mode("overwrite").parquet(f"{folder}/edges")
        files.write_text(spark, f"{folder}/fingerprint", mark)
    return spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of an exported graph document."""
    doc = spark.read.option("multiLine", "true").json(path)
    return doc.select(F.inline("nodes")), doc.select(F.inline("edges"))


def graph_document(nodes: DataFrame, links: DataFrame, scores: DataFrame) -> DataFrame:
    """One row with the graph as JSON; floats have six decimals; at most graph_max_nodes nodes."""
    n = nodes.join(scores, "template_id").select(F.struct(F.col("template_id").alias("id"), "frequency", F.col("component").alias("cluster_id"), F.round("pagerank", 6).alias("centrality_score")).alias("x"))
    e = links.select(F.struct(F.col("a").alias("source"), F.col("b").alias("target"), F.round("weight", 6).alias("weight"), F.round("pmi", 6).alias("pmi"), "cooccurrence_count").alias("x"))
    left, right = n.agg(F.array_sort(F.collect_list("x")).alias("nodes")), e.agg(F.array_sort(F.collect_list("x")).alias("edges"))
    meta = F.struct(F.size("nodes").alias("node_count"), F.size("edges").alias("edge_count")).alias("metadata")
    return left.crossJoin(right).select(F.to_json(F.struct("nodes", "edges", meta)).alias("graph"))
