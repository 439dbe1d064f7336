"""State that outlives a batch: Welford baselines, the rolling feature store, retraining."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from .features import session_frequencies

STORE = "host string, template_id string, n long, welford_mean double, welford_M2 double, seen_session_ids array<string>"


def merge_welford(store: DataFrame, rows: DataFrame) -> DataFrame:
    """The store after every session of ``rows`` that it has not seen, by pairwise merging.

    Keys without new sessions keep their row; replaying a batch changes nothing.
    """
    key = ["host", "template_id"]
    seen = store.select(*key, F.explode("seen_session_ids").alias("session_id"))
    fresh = session_frequencies(rows).join(seen, [*key, "session_id"], "left_anti")
    new = fresh.groupBy(*key).agg(
        F.count(F.lit(1)).alias("m"), F.avg("frequency").alias("mu"), (F.var_pop("frequency") * F.count(F.lit(1))).alias("s2"), F.sort_array(F.collect_set("session_id")).alias("ids")
    )
    n, m = F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0))
    mean, mu = F.coalesce("welford_mean", F.lit(0.0)), F.coalesce("mu", F.lit(0.0))
    total = n + m
    d = mu - mean
    none = F.array().cast("array<string>")
    return store.join(new, key, "full").select(
        *key,
        total.cast("long").alias("n"),
        X.safe_ratio(n * mean + m * mu, total).alias("welford_mean"),
        (F.coalesce("welford_M2", F.lit(0.0)) + F.coalesce("s2", F.lit(0.0)) + X.safe_ratio(d * d * n * m, total)).alias("welford_M2"),
        F.array_sort(F.array_union(F.coalesce("seen_session_ids", none), F.coalesce("ids", none))).alias("seen_session_ids"),
    )


def zscore_persistent(rows: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with zscore_base, new store): z against the statistics after the update."""
    after = merge_welford(store, rows)
    std = F.sqrt(F.col("welford_M2") / (F.col("n") - 1))
    z = F.when((F.col("n") >= 2) & (F.col("welford_M2") > 0) & (std >= 1e-9), X.clip((F.col("frequency") - F.col("welford_mean")) / std, -5.0, 5.0)).otherwise(0.0)
    freq = session_frequencies(rows).join(after, ["host", "template_id"]).select("host", "session_id", "template_id", z.alias("zscore_base"))
    scored = rows.join(freq, ["host", "session_id", "template_id"], "left").withColumn("zscore_base", F.coalesce("zscore_base", F.lit(0.0)))
    return scored, after


def last_sessions(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the n sessions that started last."""
    top = rows.groupBy("session_id").agg(F.min("timestamp").alias("started")).orderBy(F.desc("started"), F.desc("session_id")).limit(n)
    return rows.join(top.select("session_id"), "session_id", "left_semi")


def update_rolling_store(store: DataFrame, batch: DataFrame, n: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """Store and batch without repeats (the batch wins), cut to the last n sessions."""
    both = store.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)))
    newest = Window.partitionBy("session_id", "sequence_number").orderBy(F.desc("_batch"))
    rows = both.withColumn("_turn", F.row_number().over(newest)).filter("_turn = 1").drop("_turn", "_batch")
    return last_sessions(rows, n or config.rolling_sessions)


@dataclass
class RetrainState:
    """Rows seen so far and at the last training; training is due after enough new ones."""

    rows: int = 0
    trained_at: int = 0
    last_batch: int = -1

    def absorb(self, n: int, config: Config = DEFAULT, batch: int | None = None) -> bool:
        """Count n rows; those of a batch that was counted before do not count again."""
        if batch is not None:
            n, self.last_batch = (n if batch > self.last_batch else 0), max(batch, self.last_batch)
        self.rows += n
        return self.rows - self.trained_at >= config.retrain_every

    def trained(self) -> None:
        self.trained_at = self.rows

    def to_json(self) -> str:
        return json.dumps({"rows": self.rows, "trained_at": self.trained_at, "last_batch": self.last_batch})

    @classmethod
    def from_json(cls, text: str) -> RetrainState:
        return cls(**json.loads(text))
