"""Metrics of anomaly flags and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..sources import files


def _n(cond):
    return F.sum(cond.cast("long"))


def describe_scores(rows: DataFrame, column: str = "combined_score") -> DataFrame:
    """Rate of anomalies and count, mean, deviation, extremes and exact quartiles of the score."""
    q = lambda p: F.percentile(column, F.lit(p))
    return rows.agg(
        F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_rate"), F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), F.max(column).alias("max"),
    )


def top_templates_by_score(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.groupBy("template_id").agg(F.avg("combined_score").alias("mean_score")).orderBy(F.desc("mean_score"), "template_id").limit(n)


def confusion(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: counts, precision, recall, f1, false negative rate and noise suppression against the first truth of each key.

    Rows without a truth count as normal ones; rows without a flag as not flagged.
    """
    known = truth.withColumn("_at", F.monotonically_increasing_id()).groupBy("sequence_number").agg((F.min_by("true_label", "_at") == "anomaly").alias("_true"))
    both = rows.join(known, "sequence_number", "left")
    t, p = F.coalesce("_true", F.lit(False)), F.coalesce("is_anomaly", F.lit(False))
    c = both.agg(F.coalesce(_n(t & p), F.lit(0)).alias("tp"), F.coalesce(_n(~t & p), F.lit(0)).alias("fp"), F.coalesce(_n(t & ~p), F.lit(0)).alias("fn"), F.coalesce(_n(~t & ~p), F.lit(0)).alias("tn"))
    precision, recall = X.safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")), X.safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    c = c.withColumns({"precision": precision, "recall": recall})
    f1 = X.safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return c.withColumns({"f1": f1, "false_negative_rate": X.safe_ratio(F.col("fn"), F.col("fn") + F.col("tp")), "noise_suppression": X.safe_ratio(F.col("tn"), F.col("tn") + F.col("fp"))})


def report(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row over (label, score, truth): share of ignored rows, missed criticals, precision, recall, f1."""
    crit, hit = F.col("truth") == "critical", F.col("score") >= threshold
    c = rows.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(_n(F.col("label") == "ignore"), F.lit(0)).alias("ignored"), F.coalesce(_n(crit), F.lit(0)).alias("critical_total"),
        F.coalesce(_n(crit & ~hit), F.lit(0)).alias("critical_missed"), F.coalesce(_n(crit & hit), F.lit(0)).alias("tp"), F.coalesce(_n(~crit & hit), F.lit(0)).alias("fp"),
    )
    precision, recall = X.safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")), X.safe_ratio(F.col("tp"), F.col("critical_total"))
    c = c.withColumns({"ignored_ratio": X.safe_ratio(F.col("ignored"), F.col("total")), "critical_miss_rate": X.safe_ratio(F.col("critical_missed"), F.col("critical_total")), "precision": precision, "recall": recall})
    return c.withColumn("f1", X.safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("total", "critical_total", "ignored_ratio", "critical_miss_rate", "precision", "recall", "f1")


def evaluate(anomalies: DataFrame, features: DataFrame, truth: DataFrame | None = None, n: int = 10) -> DataFrame:
    """One row: rate and distribution of the scores, confidence, the worst templates, and the confusion figures where a truth is given."""
    named = anomalies.join(features.select("sequence_number", "template_id"), "sequence_number", "left")
    worst = top_templates_by_score(named, n).agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("mean_score", "template_id")))), lambda x: x["template_id"]).alias("top_anomalous_templates"))
    out = describe_scores(anomalies).crossJoin(anomalies.agg(F.first("model_confidence").alias("model_confidence"))).crossJoin(worst)  # one row each
    return out.crossJoin(confusion(anomalies, truth)) if truth is not None else out


def labelled_scores(scored: DataFrame, truth: DataFrame, key: str = "log_id") -> DataFrame:
    """Scores and truths of equal keys for ``report``; columns that both have get a suffix."""
    both = [c for c in truth.columns if c in scored.columns and c != key]
    left = scored.withColumnsRenamed({c: f"{c}_pred" for c in both})
    return left.join(truth.withColumnsRenamed({c: f"{c}_true" for c in both}), key)


def save_report(metrics: DataFrame, path: str) -> str:
    """Write the report of one row of metrics as a text file; returns its text."""
    text = text_report(metrics)
    files.write_text(metrics.sparkSession, path, text + "\n")
    return text


def label_distribution(rows: DataFrame) -> DataFrame:
    total = F.sum("count").over(Window.partitionBy())
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("count")).withColumn("percent", F.round(100 * F.col("count") / total, 2))


def text_report(metrics: DataFrame) -> str:
    """The one row of metrics as lines of text."""
    row = metrics.first().asDict()
    return "\n".join(f"{k}: {v:.4f}" if isinstance(v, float) else f"{k}: {v}" for k, v in row.items())
