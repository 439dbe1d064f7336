"""Anomaly scores: an isolation forest blended with the z-score, and a moving threshold."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from ..sources.scratch import staged
from .baseline import last_sessions
from .features import finite

FEATURES = ["frequency_score", "burstiness_score", "zscore_base", "time_delta_prev", "time_delta_session_start", "inter_arrival_rate", "counter_proximity"]
FORMAT = 1
OUTPUT = ["sequence_number", "isolation_score", "zscore_norm", "combined_score", "is_anomaly", "model_confidence"]


def _average_path(n):
    """Mean depth of an unsuccessful search in a tree of n points."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as flat arrays: split feature (-1 for a leaf), value, children, depth correction."""

    features: list[str]
    feature: list[list[int]]
    value: list[list[float]]
    left: list[list[int]]
    right: list[list[int]]
    depth: list[list[float]]
    psi: int
    rows: int
    format: int = FORMAT

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str, features: list[str] | None = None) -> Forest:
        """The model; refused if its format or its ordered features differ."""
        d = json.loads(text)
        if d["format"] != FORMAT:
            raise ValueError(f"model format {d['format']}, expected {FORMAT}")
        if d["features"] != (features or FEATURES):
            raise ValueError(f"model features {d['features']}, expected {features or FEATURES}")
        return cls(**d)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean depth / expected depth), in (0, 1).

        A row that ends early stays at its leaf, so each level is one pass over all
        rows without picking those that still move.
        """
        x = np.ascontiguousarray(x, float)
        cells, base = x.ravel(), np.arange(len(x)) * x.shape[1]
        total = np.zeros(len(x))
        for feature, value, child, depth, levels in self._arrays():
            node = np.zeros(len(x), np.int64)
            for _ in range(levels):
                low = cells.take(base + feature.take(node, mode="clip"), mode="clip") < value.take(node, mode="clip")
                node = child.take(2 * node + low, mode="clip")
            total += depth.take(node)
        return 2 ** (-(total / len(self.feature)) / max(float(_average_path(self.psi)), 1e-9))

    def _arrays(self) -> list[tuple]:
        """Trees as arrays: feature, value, (right, left) child, depth, levels; a leaf leads to itself.  Made once."""
        made = self.__dict__.get("_made")
        if made is None:
            made = []
            for f, v, lo, hi, d in zip(self.feature, self.value, self.left, self.right, self.depth, strict=True):
                f, own = np.array(f), np.arange(len(f))
                lo, hi = np.where(f < 0, own, lo), np.where(f < 0, own, hi)
                made.append((np.maximum(f, 0), np.array(v, float), np.stack([hi, lo], 1).ravel(), np.array(d, float), self._levels(lo, hi)))
            self.__dict__["_made"] = made
        return made

    @staticmethod
    def _levels(lo: np.ndarray, hi: np.ndarray) -> int:
        """Steps from the root to the deepest leaf."""
        level, n = np.array([0]), 0
        while len(level := np.concatenate([lo[level], hi[level]])[np.concatenate([lo[level] != level, hi[level] != level])]):
            n += 1
        return n


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> tuple[list, list, list, list, list]:
    feature, value, left, right, depth = [], [], [], [], []
    most = int(np.ceil(np.log2(max(2, len(x)))))

    def add(rows: np.ndarray, level: int) -> int:
        i = len(feature)
        for a, z in ((feature, -1), (value, 0.0), (left, -1), (right, -1), (depth, float(level + _average_path(len(rows))))):
            a.append(z)
        lo, hi = x[rows].min(0), x[rows].max(0)
        open_ = np.flatnonzero(hi > lo)
        if level < most and len(rows) > 1 and len(open_):
            f = int(rng.choice(open_))
            v = float(rng.uniform(lo[f], hi[f]))
            go = x[rows, f] < v
            if go.any() and not go.all():
                feature[i], value[i] = f, v
                left[i] = add(rows[go], level + 1)
                right[i] = add(rows[~go], level + 1)
        return i

    add(np.arange(len(x)), 0)
    return feature, value, left, right, depth


def train_forest(features: DataFrame, columns: list[str] | None = None, config: Config = DEFAULT) -> Forest:
    """A seeded forest.  Rows are drawn by a hash of their number; each tree has ``subsample`` rows of its own.

    At most trees x subsample rows reach the driver, whatever the input; where the
    table has fewer, trees draw from all of them.
    """
    columns = columns or FEATURES
    rows = features.filter(finite(columns)).select("sequence_number", *[F.col(c).cast("double").alias(c) for c in columns])
    n = rows.count()
    if not n:
        raise ValueError("no rows to train on")
    psi = min(config.subsample, n)
    most, draw = psi * config.trees, F.xxhash64(F.lit(config.seed), "sequence_number")
    # About twice the rows wanted are ordered, not the table.
    share = rows.filter(F.pmod(draw, F.lit(1 << 30)) < min(1.0, (2 * most + 1000) / n) * (1 << 30))
    x = share.orderBy(draw, "sequence_number").limit(most).toPandas()[columns].to_numpy()
    rng = np.random.default_rng(config.seed)
    own = [x[i * psi : (i + 1) * psi] if len(x) >= most else x[rng.choice(len(x), min(psi, len(x)), replace=False)] for i in range(config.trees)]
    f, v, lo, hi, d = zip(*[grow_tree(rows_, rng) for rows_ in own], strict=True)
    return Forest(columns, list(f), list(v), list(lo), list(hi), list(d), psi, n)


def add_isolation(features: DataFrame, forest: Forest) -> DataFrame:
    """raw_isolation: the forest's score, computed in Arrow batches."""

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.column_stack([c.to_numpy(float) for c in cols])))

    return features.withColumn("raw_isolation", score(*[F.col(c).cast("double") for c in forest.features]))


def _scalar(df: DataFrame, *aggs) -> DataFrame:
    return F.broadcast(df.agg(*aggs))  # one row


def minmax_isolation(rows: DataFrame, flat: float = 0.5) -> DataFrame:
    """isolation_score: the raw score on the batch's own scale, ``flat`` if it is constant."""
    ends = _scalar(rows, F.min("raw_isolation").alias("_lo"), F.max("raw_isolation").alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    return rows.crossJoin(ends).withColumn("isolation_score", F.when(hi > lo, (F.col("raw_isolation") - lo) / (hi - lo)).otherwise(F.lit(flat))).drop("_lo", "_hi")


def combine(rows: DataFrame, trained_rows: int, config: Config = DEFAULT) -> DataFrame:
    """zscore_norm, combined_score, model_confidence from isolation_score and zscore_base."""
    n = F.lit(float(trained_rows))
    z = X.zscore_norm(F.col("zscore_base"))
    return rows.withColumns(
        {"zscore_norm": z, "combined_score": X.blend(F.col("isolation_score"), z, n, config), "model_confidence": F.least(F.lit(1.0), n / config.full_confidence_rows)}
    )


def dynamic_threshold(rows: DataFrame, column: str = "combined_score", config: Config = DEFAULT, fixed: bool = True) -> DataFrame:
    """is_anomaly: above mean + k population deviations, or (if ``fixed``) above a fixed value where scores hardly vary."""
    stats = _scalar(rows, F.avg(column).alias("_mean"), F.stddev_pop(column).alias("_std"))
    limit = F.col("_mean") + config.dynamic_k * F.col("_std")
    limit = F.when(F.col("_std") < 1e-6, config.fallback_threshold).otherwise(limit) if fixed else limit
    return rows.crossJoin(stats).withColumn("is_anomaly", F.col(column) > limit).drop("_mean", "_std")


def detect(features: DataFrame, forest: Forest | None = None, config: Config = DEFAULT, flat: float = 0.5, fixed: bool = True) -> DataFrame:
    """(sequence_number, isolation_score, zscore_norm, combined_score, is_anomaly, model_confidence).

    Rows with a null or an infinite feature are left out.  Without a model one is
    trained on the batch.  Features and raw scores are written once each.
    """
    rows = features.filter(finite(FEATURES)).select("sequence_number", *FEATURES)
    if forest is None:
        rows = staged(rows, "features")
        forest = train_forest(rows, config=config)
    rows = staged(add_isolation(rows, forest).select("sequence_number", "zscore_base", "raw_isolation"), "isolation")
    out = combine(minmax_isolation(rows, flat), forest.rows, config)
    return dynamic_threshold(out, config=config, fixed=fixed).select(*OUTPUT)


def retrain(features: DataFrame, config: Config = DEFAULT) -> Forest | None:
    """A forest of the last sessions, or None on too few rows."""
    window = last_sessions(features, config.retrain_sessions).filter(finite(FEATURES))
    return train_forest(window, config=config) if window.count() >= config.min_train_rows else None


def top_anomalies(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy(F.desc("combined_score"), "sequence_number").limit(n)
