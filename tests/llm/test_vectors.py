"""Operators on vectors against brute force, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import ann, embed_dedup
from tracewright.llm.components import spanning

KIND = "vec_id long, embedding array<float>, label int"
NONE = [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] + [1.0] * 7, 1), (903, [None] + [1.0] * 7, 1), (904, [1.0], 1), (905, [float("inf")] * 8, 1), (None, [1.0] * 8, 1)]


def data(spark, n, seed=0, extra=()):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    x[n // 2 : n // 2 + 20] = x[0] + rng.normal(size=(20, 8)).astype(np.float32) * 0.05
    x[-10:] = x[1]
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows + list(extra), KIND)


def test_hilbert_keys_are_a_walk():
    g = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    k = ann.hilbert_keys(g, 3)
    assert len(np.unique(k)) == 512
    assert (np.abs(np.diff(g[np.argsort(k)], axis=0)).sum(1) == 1).all()


def test_search_recall_and_exact_scores(spark):
    x, df = data(spark, 800, extra=NONE)
    got = ann.search(df.withColumns({"rank": F.lit("clash"), "curve": F.lit(0)}), k=10, every=20).toPandas()
    x = x.astype(np.float64)
    hits = total = 0
    for q in range(0, 800, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(800), d))[:10]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11))
        assert np.allclose(mine["score"], d[mine["vec_id"]], rtol=0, atol=1e-12)
        assert sorted(zip(mine["score"], mine["vec_id"])) == list(zip(mine["score"], mine["vec_id"]))
        hits += len(set(best) & set(mine["vec_id"]))
        total += 10
    assert hits / total >= 0.9


def test_search_in_narrow_windows_of_clustered_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n, seen = 20_000, []
    centres = rng.normal(size=(1000, 32)) * 3
    x = (centres[rng.integers(0, 1000, n)] + rng.normal(size=(n, 32)) * 0.3).astype(np.float32)
    import pyarrow as pa

    measured = ann._measured
    monkeypatch.setattr(ann, "_measured", lambda *a: seen.append(measured(*a)) or seen[-1])
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(x.ravel(), 32).cast(pa.list_(pa.float32()))}))
    got = ann.search(df, k=10, every=200).toPandas()
    curves, wide = seen[0]
    assert curves * (2 * wide + 1) < n / 2
    x = x.astype(np.float64)
    hits = 0
    for q in range(0, n, 200):
        d = ann.distances(x, x[q])
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10]) & set(got.loc[got["query_id"] == q, "vec_id"]))
    assert hits / 1000 >= 0.9


def test_plan_takes_the_cheapest_curves():
    gaps = np.array([[50.0, 900.0, 3.0], [50.0, 900.0, 3.0]])
    assert ann.plan_of(gaps, 0.97) == (1, 50) and ann.plan_of(gaps * 2, 0.97) == (3, 32)
    assert ann.plan_of(np.array([[5000.0, 40.0], [40.0, 5000.0]]), 0.97) == (2, 40)
    assert ann.plan_of(np.zeros((3, 4)), 0.97) == (1, ann.LEAST)


def test_search_with_repeated_ids_and_large_values(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (1, [1.0, 0.1], 0), (1, [1.0, 0.2], 0), (2, [1.0, 5.0], 0)]
    got = ann.search(spark.createDataFrame(rows, KIND), k=2, every=100).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2] and abs(got[0]["score"] - 0.1) < 1e-6
    ids = np.array([1] * 50 + [2, 3])
    x = np.concatenate([np.tile([[1.0, 0.0]], (50, 1)), [[3.0, 0.0], [2.0, 0.0]]])
    assert ann.nearest(ids, x, np.zeros(2), 0, 3)[0].tolist() == [1, 3, 2]
    big = ann.distances(np.array([[1e200, 0.0], [3e-200, 4e-200], [-1.7e308, 0.0]]), np.array([0.0, 0.0]))
    assert np.allclose(big, [1e200, 5e-200, 1.7e308])
    wide = spark.createDataFrame([(i, [10.0 ** (i * 20 - 200), 1.0, -(10.0 ** (200 - i * 20))], 0) for i in range(20)], "vec_id long, embedding array<double>, label int")
    assert ann.search(wide, k=3, every=5).count() == 12


def test_search_ties_and_small_tables(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(30)] + [(0, [1.0, 2.0], 0)]
    got = ann.search(spark.createDataFrame(rows, KIND), k=10, every=100).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, i, 0.0) for i in range(1, 11)]
    few = ann.search(spark.createDataFrame(rows[:3], KIND), k=10, every=100).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]
    assert ann.search(spark.createDataFrame([], KIND)).count() == 0
    assert ann.search(spark.createDataFrame(NONE, KIND)).count() <= 10


@pytest.mark.parametrize(("cell_rows", "tile"), [(4096, 4096), (20, 4096), (20, 16)])
def test_near_vectors_against_brute_force(spark, monkeypatch, cell_rows, tile):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    x, df = data(spark, 300, 1, extra=[*NONE, (5, [1.0] * 8, None), (906, [1.0] * 8, None)])
    got = embed_dedup.near_duplicates(df.withColumns({"kept": F.lit("clash"), "cell": F.lit(1)}), cosine=0.93, cell_rows=cell_rows).collect()
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    lab = np.arange(300) % 3
    hit = (u @ u.T >= 0.93) & (lab[:, None] == lab[None])
    np.fill_diagonal(hit, False)
    v, root = spanning(*np.nonzero(hit))
    comp = dict(zip(v.tolist(), root.tolist()))
    n = hit.sum(1)
    assert len(got) == 309
    odd = {900, 901, 902, 903, 904, 905, 906, None}
    for r in got:
        i = r["vec_id"]
        if i in odd:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, i, True)
        elif i != 5:
            assert (r["n_links"], r["component_id"], r["kept"]) == (n[i], comp.get(i, i), comp.get(i, i) == i)


def test_near_vectors_move_by_digest(spark, monkeypatch):
    """Rows are told apart and named without their vectors; zeros of either sign are equal, labels are not."""
    written, keep = {}, embed_dedup.materialize
    monkeypatch.setattr(embed_dedup, "materialize", lambda df, tag: written.setdefault(tag, df.columns) and keep(df, tag))
    rows = [(4, [0.0, 1.0], 1), (2, [-0.0, 1.0], 1), (3, [0.0, 1.0], 2), (9, [0.1, 1.0], 1), (4, [0.0, 1.0], 1)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(2, 3, 2), (3, 0, 3), (4, 3, 2), (4, 3, 2), (9, 3, 2)]
    assert written["keys"] == ["vec_id", "key"] and written["named"] == ["key", "found", "root", "n"]


def test_vectors_of_nothing(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], KIND)).count() == 0
    assert embed_dedup.near_duplicates(spark.createDataFrame(NONE, KIND)).count() == len(NONE)


def test_near_vectors_of_many_labels_and_odd_sizes(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)) * 10.0 ** rng.integers(-200, 200, 400)[:, None]
    x[200:] = x[:200] * 1e3 * (1 + 0.05 * rng.normal(size=(200, 8)))
    lab = np.where(np.arange(400) % 200 < 120, 0, np.arange(400) % 200)  # one common label, many rare ones
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, lab))], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicates(df, cell_rows=10).collect()}
    u = embed_dedup.unit(x)
    hit = (u @ u.T >= 0.93) & (lab[:, None] == lab[None])
    np.fill_diagonal(hit, False)
    assert hit.sum() > 300 and np.isfinite(u).all()
    v, root = spanning(*np.nonzero(hit))
    comp = dict(zip(v.tolist(), root.tolist()))
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(400)] == [(hit[i].sum(), comp.get(i, i)) for i in range(400)]


def test_cosines_at_the_limit_agree_in_both_orders():
    rng = np.random.default_rng(8)
    for a, b in rng.normal(size=(200, 2, 64)):
        assert embed_dedup.exact_cosine(a, b) == embed_dedup.exact_cosine(b, a)
    x = embed_dedup.unit(rng.normal(size=(300, 5)))
    c = embed_dedup.exact_cosine(x[3], x[250])
    ids, n, home, enters = np.arange(300), np.ones(300, np.int64), np.zeros(300, np.int64), np.ones((300, 1), bool)
    links, more, _, _ = embed_dedup.tile_links(0, (ids, x, n, home, enters), None, c)
    exact = np.array([[embed_dedup.exact_cosine(x[i], x[j]) >= c for j in range(300)] for i in (3, 250)])
    assert (links + more)[[3, 250]].tolist() == (exact.sum(1) - 1).tolist()


def test_cells_lose_no_link():
    rng = np.random.default_rng(2)
    x = embed_dedup.unit(rng.normal(size=(400, 6)))
    c = embed_dedup.spherical_kmeans(x, 9)
    home, enters = embed_dedup.cells_of(x, c, 0.9)
    i, j = np.nonzero(x @ x.T >= 0.9)
    assert (enters[j, home[i]] | enters[i, home[j]]).all() and enters.mean() < 0.6


def test_evenly_spread_vectors_move_once(spark, monkeypatch):
    """Vectors that would enter many cells get one cell; clustered ones keep theirs."""
    rng, placed = np.random.default_rng(2), []
    fitted = embed_dedup._centres
    monkeypatch.setattr(embed_dedup, "WORTH", 4000)
    monkeypatch.setattr(embed_dedup, "_centres", lambda *a: placed.append(fitted(*a)) or placed[-1])
    even = rng.normal(size=(3000, 32)).astype(np.float32)
    lumps = (rng.normal(size=(40, 32))[rng.integers(0, 40, 3000)] * 4 + rng.normal(size=(3000, 32)) * 0.3).astype(np.float32)
    for x, most in ((even, 1.0), (lumps, 1.5)):
        df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], KIND)
        got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(df).collect()}
        u = embed_dedup.unit(x.astype(np.float64))
        assert [got[i] for i in range(3000)] == ((u @ u.T >= 0.93).sum(1) - 1).tolist()
        assert embed_dedup.cells_of(u, placed[-1][0][1], 0.93)[1].sum(1).mean() <= most
    assert len(placed[0][0][1]) == 1 < len(placed[1][0][1])
    assert embed_dedup.block_rows(64) == embed_dedup.TILE and embed_dedup.block_rows(1024) * 1024 <= embed_dedup.COMPONENTS
