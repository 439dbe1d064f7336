"""Features of a log row from its session, its template and its neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from ..sources.logs import require_columns
from .sessions import SLICE_US

INPUT = ["sequence_number", "session_id", "template_id", "host", "timestamp", "frequency", "log_level", "event_weight"]
COLUMNS = [
    "sequence_number", "session_id", "template_id", "host", "timestamp", "frequency_score", "burstiness_score", "zscore_base",
    "time_delta_prev", "time_delta_session_start", "inter_arrival_rate", "event_weight", "counter_proximity",
]
#: Rows of history after which an earlier value weighs less than 1e-17.
EMA_ROWS = 110


def session_features(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Time, frequency and burst features; one shuffle and one sort by session."""
    whole = Window.partitionBy("session_id")
    order = whole.orderBy("_us", "sequence_number")
    a = config.ema_alpha
    rows = rows.withColumn("_us", X.micros(F.col("timestamp")))
    rows = rows.withColumn("_gap", (F.col("_us") - F.lag("_us").over(order)) / 1e6)
    rows = rows.withColumns({"time_delta_prev": F.coalesce("_gap", F.lit(0.0)), "time_delta_session_start": (F.col("_us") - F.min("_us").over(whole)) / 1e6})
    mean, var = F.avg("_gap").over(whole), F.var_samp("_gap").over(whole)
    burst = F.when((F.count("_gap").over(whole) >= 2) & (mean != 0), X.clip(var / mean, 0.0, 10.0)).otherwise(0.0)
    most = F.max("frequency").over(whole)
    recent = F.collect_list("time_delta_prev").over(order.rowsBetween(-EMA_ROWS, 0))
    ema = F.aggregate(recent, F.lit(None).cast("double"), lambda y, x: F.coalesce(a * x + (1 - a) * y, x))
    return rows.withColumns({"burstiness_score": burst, "frequency_score": X.safe_ratio(F.col("frequency"), most), "inter_arrival_rate": ema}).drop("_us", "_gap")


def counter_proximity(rows: DataFrame, counter=None, config: Config = DEFAULT) -> DataFrame:
    """counter_proximity: 1 / (1 + seconds) to the nearest counter row of the host within the window, else 0.

    Rows are windowed by host and slice of time; counter rows near a border also
    stand in the slice next to it, so no host is one task's work.
    """
    wide = config.proximity_window_s * 1_000_000
    mark = counter if counter is not None else X.is_counter(F.col("template_id"))
    us = X.micros(F.col("timestamp"))
    base = rows.withColumns({"_us": us, "_slice": F.floor(us / SLICE_US), "_counter": F.when(mark, us), "_own": F.lit(True)})
    near = F.array(F.floor((F.col("_us") - wide) / SLICE_US), F.floor((F.col("_us") + wide) / SLICE_US))
    ghosts = base.filter("_counter is not null").select("host", "_us", "_counter", F.col("_slice").alias("_home"), F.explode(near).alias("_slice")).filter("_slice <> _home")
    both = base.unionByName(ghosts.drop("_home"), allowMissingColumns=True)
    w = Window.partitionBy("host", "_slice").orderBy("_us")
    left = F.max("_counter").over(w.rangeBetween(-wide, 0))
    right = F.min("_counter").over(w.rangeBetween(0, wide))
    gap = F.least(F.col("_us") - left, right - F.col("_us")) / 1e6
    out = both.withColumn("counter_proximity", F.coalesce(1 / (1 + gap), F.lit(0.0)))
    return out.filter("_own").drop("_us", "_slice", "_counter", "_own")


def session_frequencies(rows: DataFrame) -> DataFrame:
    """(host, session_id, template_id, frequency, started): one row per session and template."""
    first = rows.groupBy("host", "session_id", "template_id").agg(F.max("frequency").alias("frequency"), F.min("timestamp").alias("_ts"))
    return first.withColumn("started", F.min("_ts").over(Window.partitionBy("host", "session_id"))).drop("_ts")


def zscore_rolling(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """``rows`` with zscore_base against the previous sessions of the host's template."""
    freq = session_frequencies(rows)
    past = Window.partitionBy("host", "template_id").orderBy("started", "session_id").rowsBetween(-config.baseline_sessions, -1)
    n, mean, std = F.count("frequency").over(past), F.avg("frequency").over(past), F.stddev_samp("frequency").over(past)
    z = F.when((n >= 2) & (std > 0), X.clip((F.col("frequency") - mean) / std, -5.0, 5.0)).otherwise(0.0)
    scored = freq.select("host", "session_id", "template_id", z.alias("zscore_base"))
    return rows.join(scored, ["host", "session_id", "template_id"], "left").withColumn("zscore_base", F.coalesce("zscore_base", F.lit(0.0)))


def add_severity_weight(rows: DataFrame) -> DataFrame:
    """Severity already stands in event_weight; kept as a step of its own."""
    return rows


def finite(columns: list[str]):
    """Condition that all columns are present and finite."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return cond


def build_features(rows: DataFrame, zscored: DataFrame | None = None, counter=None, config: Config = DEFAULT) -> DataFrame:
    """The 13 feature columns; ``zscored`` brings zscore_base, by default from the rolling baseline."""
    require_columns(rows, INPUT, "sessionized logs")
    out = zscored if zscored is not None else zscore_rolling(rows, config)
    out = counter_proximity(session_features(out, config), counter, config)
    return add_severity_weight(out).select(*COLUMNS)


def validate_features(features: DataFrame) -> DataFrame:
    """The features, or an error naming how many rows have a null or an infinite value."""
    bad = features.filter(~finite([c for c, t in features.dtypes if t == "double"])).count()
    if bad:
        raise ValueError(f"{bad} feature rows hold nulls or infinite values")
    return features


def unmatched_hints(rows: DataFrame) -> DataFrame:
    """Templates that sound like counter anomalies but match no pattern, each once."""
    return rows.select("template_id").distinct().filter(X.is_counter_hint(F.col("template_id")))
