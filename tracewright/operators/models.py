"""Saved forests: versions with a sidecar, checks before loading, retraining on a window."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..logger import get_logger
from ..sources import files
from . import anomaly
from .baseline import RetrainState
from .features import finite

log = get_logger(__name__)
VERSIONS = {"format": f"{anomaly.FORMAT}.0", "numpy": np.__version__}


class ModelStore:
    """Models of one folder, on any file system: ``isolation_forest_v<time>.model`` with ``.json`` beside it."""

    def __init__(self, spark: SparkSession, folder: str, config: Config = DEFAULT):
        self.spark, self.folder, self.config = spark, folder, config

    def _path(self, time: str, kind: str) -> str:
        return f"{self.folder}/isolation_forest_v{time}.{kind}"

    def versions(self) -> list[str]:
        """Times of the saved models, oldest first."""
        return [p.rsplit("_v", 1)[1].removesuffix(".model") for p in files.listed(self.spark, self.folder, "isolation_forest_v*.model")]

    def save(self, forest: anomaly.Forest, time: str | None = None) -> str:
        """Write the model and then its sidecar, without which it is not loaded; returns its time."""
        time = time or datetime.now(UTC).strftime("%Y%m%d_%H%M%S")
        c = self.config
        about = {
            "timestamp": time, "n_samples": forest.rows, "feature_columns": forest.features, "trees": len(forest.feature), "subsample": forest.psi,
            "weights": {"isolation": c.isolation_weight, "zscore": c.zscore_weight}, "versions": VERSIONS,
        }
        files.write_text(self.spark, self._path(time, "model"), forest.to_json())
        files.write_text(self.spark, self._path(time, "json"), json.dumps(about))
        return time

    def problem(self, time: str) -> str | None:
        """Why a model must not be used, or None: its sidecar, its ordered features, the major versions it was made with."""
        try:
            about = json.loads(files.read_text(self.spark, self._path(time, "json")))
        except FileNotFoundError:
            return "no sidecar"
        except ValueError:
            return "unreadable sidecar"
        if about.get("feature_columns") != anomaly.FEATURES:
            return f"features {about.get('feature_columns')}, expected {anomaly.FEATURES}"
        for name, now in VERSIONS.items():
            then = str(about.get("versions", {}).get(name, ""))
            if then.split(".")[0] != now.split(".")[0]:
                return f"{name} {then or 'unknown'}, now {now}"
            if then != now:
                log.warning("model %s was made with %s %s, now %s", time, name, then, now)
        return None

    def load(self, time: str | None = None) -> anomaly.Forest | None:
        """The newest model, None if there is none or it must not be used; or the one of a time, an error if it is missing."""
        if time is not None:
            return anomaly.Forest.from_json(files.read_text(self.spark, self._path(time, "model")))
        saved = self.versions()
        if not saved:
            return None
        why = self.problem(saved[-1])
        if why:
            log.warning("model %s is not loaded: %s", saved[-1], why)
            return None
        return self.load(saved[-1])

    def state(self) -> RetrainState:
        try:
            return RetrainState.from_json(files.read_text(self.spark, f"{self.folder}/retrain_state.json"))
        except FileNotFoundError:
            return RetrainState()

    def retrain(self, features: DataFrame, time: str | None = None) -> anomaly.Forest | None:
        """Train on the last sessions and save; None on too few rows."""
        forest = anomaly.retrain(features, self.config)
        if forest is not None:
            self.save(forest, time)
        return forest

    def maybe_retrain(self, features: DataFrame, time: str | None = None) -> anomaly.Forest | None:
        """Retrain once the table has grown by enough rows since the last training."""
        state, n = self.state(), features.count()
        if n - state.trained_at < self.config.retrain_every:
            return None
        forest = self.retrain(features, time)
        files.write_text(self.spark, f"{self.folder}/retrain_state.json", RetrainState(n, n).to_json())
        return forest

    def detect(self, features: DataFrame, history: DataFrame | None = None, time: str | None = None) -> DataFrame:
        """Score with the newest model, or with one trained on these rows; then retrain if it is due.

        A new model serves the next run only.  ``history`` is the table to retrain on
        (default: these rows).  With too few rows to train on, the z-score alone
        counts: the isolation score is 0.5 and the confidence 0.
        """
        forest = self.load()
        if forest is None and features.filter(finite(anomaly.FEATURES)).count() < self.config.min_train_rows:
            rows = features.filter(finite(anomaly.FEATURES)).withColumn("isolation_score", F.lit(0.5))
            out = anomaly.dynamic_threshold(anomaly.combine(rows, 0, self.config), config=self.config).select(*anomaly.OUTPUT)
        else:
            out = anomaly.detect(features, forest, self.config)
        self.maybe_retrain(history if history is not None else features, time)
        return out

