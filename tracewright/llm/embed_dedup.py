"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Vectors of one label that are equal collapse to one with a count.  Every other
vector has a home cell, the centre of largest cosine among its label's centres.
The ends of a link lie at most a chord apart, so if they have different homes one
of them is within half a chord of the plane between these: a vector visits each
cell whose plane with its home is that near, and no link is lost.  A link shows
where both ends are at home, or else in the home of one that the other visits;
if each visits the other's, the smaller cell counts it.

Cells are cut into blocks of bounded size and each two blocks are compared by one
task, in smaller products.  A task returns each row's number of links and a
spanning forest, never all pairs.

Centres are fitted on a bounded sample, as many as make copies of vectors and products
least (cells entered are measured on the sample; evenly spread vectors get one cell, in
which each moves once per block), per label for the labels that hold much of
the table and for all others together; the assignment, and what is compared, cover
all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import matrix, valid_vectors
from .common import join_hot, materialize
from .components import connected_components, spanning

#: Rows of the sample, rows per cell, most cells of a label, labels with centres of their own, most rows of a block, rows of a product's sides.
COSINE, SAMPLE, CELL_ROWS, MOST_CELLS, OWN_LABELS, TILE, BLOCK, ACROSS = 0.93, 16_384, 64, 1024, 64, 65_536, 512, 8192
#: Most components in a block; products of one vector that cost as much as to move it once more.
COMPONENTS, WORTH = 1 << 22, 65_536
#: Cosines this near to the limit are decided by one exact sum; cells of many rows up to which their table is broadcast.
EDGE, FEW_CELLS = 1e-9, 10_000


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Unit centres; rows of ``x`` are unit vectors."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; components are scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine by correctly rounded sums, the same for (a, b) and (b, a)."""
    return fsum((a * b).tolist()) / np.sqrt(fsum((a * a).tolist()) * fsum((b * b).tolist()))


def cells_of(x: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, rows x cells mask of the cells that each unit vector enters)."""
    dots = x @ centres.T
    home = np.argmax(dots, axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ centres.T)))
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) / 2 + 1e-6  # half the longest chord of a link
    gap = dots[np.arange(len(x)), home][:, None] - dots
    enters = gap <= reach * apart[home] + 1e-6
    enters[np.arange(len(x)), home] = True
    return home, enters


def tile_links(
    cell: int, a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...] | None, cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of rows of a, links of rows of b, forest edges u, v) between two blocks of a cell, or inside one.

    A block is (ids, unit vectors, counts, homes, mask of the cells entered).
    """
    ids, x, n, home, enters = a
    ids2, x2, n2, home2, enters2 = b or a
    links, links2 = np.zeros(len(ids), np.int64), np.zeros(len(ids2), np.int64)
    u, v = [ids[:0]], [ids[:0]]
    for lo in range(0, len(ids), BLOCK):
        found = []
        for start in range(lo if b is None else 0, len(ids2), ACROSS):  # inside a block, pairs are taken once
            cos = x[lo : lo + BLOCK] @ x2[start : start + ACROSS].T
            i, j = np.nonzero(cos >= cosine - EDGE)
            found.append((i + lo, j + start, cos[i, j]))
        if not found:
            continue
        i, j, near = map(np.concatenate, zip(*found))
        keep = (i < j) if b is None else np.ones(len(i), bool)
        for at in np.flatnonzero(keep & (near < cosine + EDGE)):
            keep[at] = exact_cosine(x[i[at]], x2[j[at]]) >= cosine
        i, j = i[keep], j[keep]
        # Both at home: counted here.  One visits: here unless the other enters the visitor's home too and that is the smaller cell.
        one, two = home[i] == cell, home2[j] == cell
        other = (one & ~two & enters[i, home2[j]] & (home2[j] < cell)) | (~one & two & enters2[j, home[i]] & (home[i] < cell))
        mine = (one | two) & ~other
        i, j = i[mine], j[mine]
        if len(i):
            links += np.bincount(i, weights=n2[j], minlength=len(ids)).astype(np.int64)
            links2 += np.bincount(j, weights=n[i], minlength=len(ids2)).astype(np.int64)
            p, q = spanning(ids[i], ids2[j])
            u.append(p[p != q])
            v.append(q[p != q])
    p, q = np.concatenate(u), np.concatenate(v)
    if len(p):
        p, q = spanning(p, q)
    return links, links2, p[p != q], q[p != q]


def block_rows(dim: int) -> int:
    """Rows of a block: a task holds two."""
    return max(1, min(TILE, COMPONENTS // max(1, dim)))


def cost(n: int, k: int, entered: float, tile: int) -> float:
    """Times that one of n vectors moves (once per cell entered and block of it), and its products in such units."""
    return entered * np.ceil(max(1.0, n * entered / k) / tile) + n * entered**2 / k / WORTH


def _centres(same: DataFrame, sample: int, cell_rows: int, cosine: float) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """(centres of the labels that hold at least one in ``OWN_LABELS`` of the rows, centres of all others)."""
    total = same.count()
    sizes = same.groupBy("label").count().filter(F.col("count") * OWN_LABELS >= total).collect()  # at most OWN_LABELS rows
    own = {r["label"]: r["count"] for r in sizes}
    rest = same.filter(~F.col("label").isin(list(own))) if own else same
    most, left = rest.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    # A row is drawn by its hash; the share of each kind of label makes about ``sample`` rows in all, and no more come.
    each = sample / (len(own) + 1)
    share = F.lit(each / max(1, left))
    for k, n in own.items():
        share = F.when(F.col("label") == k, each / n).otherwise(share)
    drawn = same.filter(F.pmod(F.xxhash64(F.lit(5), "rep"), F.lit(1 << 20)) < share * (1 << 20))
    picked = drawn.select("label", "vec").limit(2 * sample).toArrow()
    label, x = np.array(picked.column("label").to_pylist(), np.int64), matrix(picked.column("vec").combine_chunks())
    x = unit(x) if len(x) else x

    def fit(rows: np.ndarray, n: int) -> np.ndarray:
        k, best = int(min(MOST_CELLS, max(1, n // cell_rows), len(rows))), (np.inf, rows[:1])
        while k:
            found = spherical_kmeans(rows, k)
            now = cost(n, k, cells_of(rows, found, cosine)[1].sum(1).mean(), block_rows(x.shape[1]))
            best = (now, found) if now < best[0] else best
            k //= 2
        return best[1]

    other = x[~np.isin(label, list(own))]
    return {k: fit(x[label == k], n) for k, n in own.items() if (label == k).any()}, fit(other, most) if len(other) else np.zeros((1, x.shape[1]))


def kept_type(kind) -> str:
    """Vectors of floats travel as floats; they are exact as doubles whenever they are computed with."""
    return "array<float>" if kind.simpleString() == "array<float>" else "array<double>"


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Only rows of equal, non-null labels link.  Vectors that are null, zero, of an
    odd length or not finite have no link and stand for themselves, as do rows
    with a null label or a null id.  Rows that repeat a vec_id count as separate
    vectors with one name.  An empty table gives no row.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast(kept_type(vectors.schema["embedding"].dataType)).alias("vec"))
    fine = valid_vectors(rows.withColumnRenamed("vec", "embedding").filter("label is not null").select("vec_id", "embedding"))
    dim = fine.select(F.size("vec")).first()
    alone = lambda df: df.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if dim is None:
        return alone(rows)
    ok = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") == dim[0])
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0), F.lit(False)
    )

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, x = b.column(1).to_numpy(), matrix(b.column(2)) + 0.0  # no negative zeros
            keys = [blake2b(v.tobytes(), digest_size=16, key=k.tobytes()).digest() for k, v in zip(labels, x)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], ["vec_id", "label", "vec", "key"])

    # Vectors move by a digest of 128 bits; they themselves move once to be told apart, and once per cell.
    keyed = rows.filter(ok).mapInArrow(name, f"vec_id long, label long, vec {rows.schema['vec'].dataType.simpleString()}, key binary")
    least = F.min_by(F.struct("label", "vec"), "vec_id")
    same = keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), least.alias("own"))
    same = materialize(same.select("own.label", "own.vec", "rep", "n", "key"), "distinct")
    centres, shared = _centres(same, sample, cell_rows, cosine)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = b.column(0).to_numpy()
            for k in np.unique(labels).tolist():
                part = b.filter(pa.array(labels == k))
                home, enters = cells_of(unit(matrix(part.column(1))), centres.get(k, shared), cosine)
                row, cell = np.nonzero(enters)
                took = part.take(pa.array(row))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(enters.sum(1)))).astype(np.int32)), pa.array(cell.astype(np.int32)))
                more = [pa.array(cell.astype(np.int32)), pa.array(home[row].astype(np.int32)), lists.take(pa.array(row))]
                yield pa.RecordBatch.from_arrays([*took.columns, *more], [*took.schema.names, "cell", "home", "enters"])

    placed = same.select("label", "vec", "rep", "n").mapInArrow(place, f"label long, vec {same.schema['vec'].dataType.simpleString()}, rep long, n long, cell int, home int, enters array<int>")
    # A cell of many rows is cut into blocks; a row goes to the tasks that compare its block with each block.
    blocks = placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows(dim[0])).cast("int").alias("blocks")).filter("blocks > 1")
    blocks = materialize(blocks, "blocks")
    split = placed.join(F.broadcast(blocks) if blocks.count() <= FEW_CELLS else blocks, ["label", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    split = split.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    split = split.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    width = max([len(shared), *map(len, centres.values())])

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        col = lambda c: t.column(c).combine_chunks()
        ids, n, home, block, x = col("rep").to_numpy(), col("n").to_numpy(), col("home").to_numpy(), col("block").to_numpy(), unit(matrix(col("vec")))
        lists = col("enters")
        enters = np.zeros((len(ids), width), bool)
        enters[np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()] = True
        cell, low, high = (t.column(c)[0].as_py() for c in ("cell", "low", "high"))
        side = lambda at: tuple(z[at] for z in (ids, x, n, home, enters))
        one, two = block == low, block == high
        if low == high:
            p, q, u, v = tile_links(cell, side(one), None, cosine)
            names, counts = ids[one], p + q
        else:
            p, q, u, v = tile_links(cell, side(one), side(two), cosine)
            names, counts = np.concatenate([ids[one], ids[two]]), np.concatenate([p, q])
        names, counts = names[counts > 0], counts[counts > 0]
        return pa.table(
            [pa.array(np.concatenate([names, u])), pa.array(np.concatenate([names, v])), pa.array(np.concatenate([counts, np.zeros(len(u), np.int64)]))], ["u", "v", "links"]
        )

    found = split.select("label", "cell", "low", "high", "rep", "n", "vec", "home", "enters", "block").groupBy("label", "cell", "low", "high").applyInArrow(compare, "u long, v long, links long")
    found = materialize(found, "links")
    links = found.filter("u = v").groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.select("u", "v")).withColumnRenamed("u", "rep")
    named = same.join(links, "rep", "left").join(roots, "rep", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("found"), F.coalesce("root", "rep").alias("root"), "n"
    )
    joined = join_hot(materialize(keyed.select("vec_id", "key"), "keys"), materialize(named, "named"), "key")
    return joined.select("vec_id", F.col("found").cast("long").alias("n_links"), F.col("root").alias("component_id"), (F.col("root") == F.col("vec_id")).alias("kept")).unionByName(alone(rows.filter(~ok)))
