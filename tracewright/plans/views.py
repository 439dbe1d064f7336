"""What dashboards ask for: incidents, hosts, searches, summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X


def incident_rollup(rows: DataFrame) -> DataFrame:
    """Per incident: time span, rows, worst label by rank, cross-system flag, hosts."""
    got = rows.filter("correlation_id is not null").groupBy("correlation_id").agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.count(F.lit(1)).alias("log_count"),
        F.max_by("label", X.label_rank(F.col("label"))).alias("label"), F.max("is_cross_system").alias("is_cross_system"), F.min("host").alias("host"), F.count_distinct("host").alias("host_count"),
    )
    return got.withColumn("duration_s", F.timestamp_diff("SECOND", "start_time", "end_time"))


def incidents(rows: DataFrame, host: str | None = None, severity: list[str] | None = None, start=None, end=None, cross_only: bool = False, limit: int = 200) -> DataFrame:
    if host:
        rows = rows.filter(F.col("host") == host)
    got = incident_rollup(rows)
    for cond in (F.col("label").isin(severity) if severity else None, F.col("start_time") >= start if start else None, F.col("start_time") <= end if end else None, F.col("is_cross_system") if cross_only else None):
        got = got if cond is None else got.filter(cond)
    return got.withColumn("duration", X.duration_text(F.col("duration_s"))).orderBy(F.desc("start_time"), "correlation_id").limit(limit)


def incident_cards(rollup: DataFrame, limit: int = 200) -> DataFrame:
    """Incidents by severity, the worst first."""
    return rollup.orderBy(F.desc(X.label_rank(F.col("label"))), F.desc("start_time"), "correlation_id").limit(limit)


def feed_tiles(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.count(F.lit(1)).alias("total"), F.sum((F.col("label") == "critical").cast("long")).alias("critical"), F.sum(F.col("is_cross_system").cast("long")).alias("cross_system"), F.mode("host", True).alias("top_host")
    )


def hosts(rows: DataFrame) -> DataFrame:
    return rows.select("host").distinct()


def host_stats(rows: DataFrame) -> DataFrame:
    """Per host: incidents, critical incidents, share of anomalous rows, start of the last incident."""
    per = rows.groupBy("host", "correlation_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_anomaly").cast("long")).alias("odd"), F.min("timestamp").alias("started"), F.max(X.label_rank(F.col("label"))).alias("rank"))
    known = F.col("correlation_id").isNotNull()
    return per.groupBy("host").agg(
        F.sum(known.cast("long")).alias("incident_count"), F.sum((known & (F.col("rank") == 3)).cast("long")).alias("critical_count"),
        (F.sum("odd") / F.sum("n")).alias("anomaly_rate"), F.max(F.when(known, F.col("started"))).alias("last_incident_at"),
    )


def host_tiles(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("incident_count").alias("incidents"), F.sum("critical_count").alias("critical"), F.avg("anomaly_rate").alias("mean_rate"),
        F.max_by("host", F.struct("anomaly_rate", "host")).alias("worst_host"),
    )


def worst_hosts(stats: DataFrame, n: int = 20) -> DataFrame:
    return stats.withColumn("colour", X.rate_colour(F.col("anomaly_rate"))).orderBy(F.desc("anomaly_rate"), "host").limit(n)


def incidents_by_hour(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("incidents"))


def anomaly_rate_by_hour(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour")).agg(F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_rate"))


def score_panels(rows: DataFrame) -> DataFrame:
    """Per day and label: rows, median and mean score, distinct flags."""
    return rows.groupBy(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("day"), "label").agg(
        F.count(F.lit(1)).alias("count"), F.median("final_score").alias("median_score"), F.avg("final_score").alias("mean_score"), F.count_distinct("is_anomaly").alias("flags")
    )


def incident_logs(rows: DataFrame, incident: str) -> DataFrame:
    own = rows.filter(F.col("correlation_id") == incident)
    several = F.broadcast(own.agg((F.count_distinct("host") > 1).alias("several_hosts")))  # one row
    return own.crossJoin(several).select("sequence_number", "timestamp", "host", "template_id", "label", F.col("final_score").alias("importance_score"), "is_root_cause", "message", "several_hosts")


def incident_causes(causes: DataFrame, rows: DataFrame, incident: str) -> DataFrame:
    own = causes.filter(F.col("incident_id") == incident).select("incident_id", "sequence_number", "root_cause_log_id", "confidence_score")
    return own.join(rows.select("sequence_number", "template_id", "host"), "sequence_number").withColumn("band", X.confidence_band(F.col("confidence_score")))


def best_causes(rollup: DataFrame, causes: DataFrame) -> DataFrame:
    """Incidents with their most certain root cause."""
    first = Window.partitionBy("incident_id").orderBy(F.desc("confidence_score"), "root_cause_log_id")
    best = causes.withColumn("_turn", F.row_number().over(first)).filter("_turn = 1").select(F.col("incident_id").alias("correlation_id"), "root_cause_log_id", "confidence_score")
    return rollup.join(best, "correlation_id", "left")


def timeline(rows: DataFrame) -> DataFrame:
    """Rows with a time; missing labels are low, missing root marks false."""
    return rows.filter("timestamp is not null").select("sequence_number", "timestamp", "host", F.coalesce("label", F.lit("low")).alias("label"), F.coalesce("is_root_cause", F.lit(False)).alias("is_root_cause"), F.coalesce("final_score", F.lit(0.0)).alias("final_score"))


def visible_graph(nodes: DataFrame, links: DataFrame, odd: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """The n most central nodes, marked where anomalous, and the edges among them."""
    top = nodes.orderBy(F.desc("pagerank"), "template_id").limit(n)
    marks = odd.filter(F.col("label").isin("critical", "medium")).select("template_id", F.lit(True).alias("_odd")).distinct()
    seen = top.join(marks, "template_id", "left").withColumn("anomalous", F.coalesce("_odd", F.lit(False))).drop("_odd")
    ids = top.select("template_id")
    both = links.join(F.broadcast(ids), links.a == ids.template_id, "left_semi")
    return seen, both.join(F.broadcast(ids), both.b == ids.template_id, "left_semi")  # n rows


def search_logs(rows: DataFrame, query: str | None = None, host: str | None = None, label: str | None = None, since=None, size: int = 100) -> DataFrame:
    """Rows whose message holds every word of the query, newest first."""
    for word in (query or "").lower().split():
        rows = rows.filter(F.contains(F.lower("message"), F.lit(word)))
    for c, v in (("host", host), ("label", label)):
        rows = rows.filter(F.col(c) == v) if v else rows
    rows = rows.filter(F.col("timestamp") >= since) if since is not None else rows
    return rows.orderBy(F.desc("timestamp"), "sequence_number").limit(min(500, max(10, size)))


def top_counts(rows: DataFrame, column: str, n: int = 3) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column).limit(n)


def summary_context(rows: DataFrame, causes: DataFrame, most: int = 10) -> DataFrame:
    """Per incident what a summary needs: ordered distinct templates, causes, hosts, duration, worst label.

    First times per template are aggregated before they are listed, so an incident
    of many rows lists templates, not rows.
    """
    own = rows.filter("correlation_id is not null")
    seen = own.groupBy("correlation_id", "template_id").agg(F.min("timestamp").alias("t"), F.min("sequence_number").alias("s"))
    turn = F.row_number().over(Window.partitionBy("correlation_id").orderBy("t", "s"))
    n = F.count(F.lit(1)).over(Window.partitionBy("correlation_id"))
    first = seen.withColumns({"_turn": turn, "_n": n}).filter(F.col("_turn") <= most)
    listed = first.groupBy("correlation_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_turn", "template_id"))), lambda x: x["template_id"]), " -> ").alias("listed"), F.max("_n").alias("_n"))
    text = F.when(F.col("_n") > most, F.concat("listed", F.format_string(" ... (+%d more)", F.col("_n") - most))).otherwise(F.col("listed"))
    per = own.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("log_count"), F.array_join(F.sort_array(F.collect_set("host")), ", ").alias("hosts"), F.timestamp_diff("SECOND", F.min("timestamp"), F.max("timestamp")).alias("duration_s"),
        F.max_by("label", X.label_rank(F.col("label"))).alias("worst_label"), F.max("is_cross_system").alias("is_cross_system"),
    )
    roots = causes.groupBy(F.col("incident_id").alias("correlation_id")).agg(F.array_join(F.array_sort(F.collect_list("root_cause_log_id")), ", ").alias("root_causes"))
    return per.join(listed.select("correlation_id", text.alias("sequence")), "correlation_id").join(roots, "correlation_id", "left").withColumn("root_causes", F.coalesce("root_causes", F.lit("none")))


def missing_summaries(context: DataFrame, summaries: DataFrame) -> DataFrame:
    return context.join(summaries, "correlation_id", "left_anti")


def get_summary(summaries: DataFrame, incident: str) -> str | None:
    row = summaries.filter(F.col("correlation_id") == incident).select("summary_text").first()
    return row[0] if row else None


#: Hours of the time windows on offer (fixed values); a week is the default.
PRESET_HOURS = (1, 6, 24, 168, 720)


def recent(rows: DataFrame, hours: int = 168, now=None, column: str = "timestamp") -> DataFrame:
    """Rows of the last hours before ``now``, by default before the current time."""
    now = (F.lit(now) if now is not None else F.current_timestamp()).cast("timestamp_ntz")
    return rows.filter((F.col(column) >= F.timestamp_add("HOUR", F.lit(-hours), now)) & (F.col(column) <= now))


def summarize_missing(context: DataFrame, stored: DataFrame, summariser: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Summaries of the incidents that have none; where a summariser gives no text, the template's counts."""
    todo = missing_summaries(context, stored.select("correlation_id"))
    plain = summarize(todo)
    if summariser is None:
        return plain
    got = summariser(todo).select("correlation_id", F.trim("summary_text").alias("_text"))
    return plain.join(got, "correlation_id", "left").select("correlation_id", F.coalesce(F.nullif("_text", F.lit("")), "summary_text").alias("summary_text"))


def summarize(context: DataFrame) -> DataFrame:
    """A deterministic summary text; ``summarize_missing`` takes another summariser."""
    text = F.format_string("%d logs on %s over %s, worst label %s: %s. Root causes: %s.", "log_count", "hosts", X.duration_text(F.col("duration_s")), "worst_label", "sequence", "root_causes")
    return context.select("correlation_id", text.alias("summary_text"))
