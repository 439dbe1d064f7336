"""Sessions of a host and what is counted inside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X

#: Microseconds of a slice; a host's rows are worked on slice by slice, so a busy host is many tasks' work.
SLICE_US = 86_400_000_000


def sessionize(logs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """``logs`` with session_id: a new session at a gap of more than the limit on a host.

    Rows are windowed by host and day, not by host: what a day needs from the days
    before it (the last time, the start of the open session) comes from a table of
    one row per host and day.  Rows are shuffled and sorted once.
    """
    gap = config.session_gap_s * 1_000_000
    us = X.micros(F.col("timestamp"))
    order = Window.partitionBy("host", "_slice").orderBy("_us", "sequence_number")
    rows = logs.withColumns({"_us": us, "_slice": F.floor(us / SLICE_US)})
    rows = rows.withColumn("_open", F.when(F.col("_us") - F.lag("_us").over(order) > gap, F.col("_us")))
    days = rows.groupBy("host", "_slice").agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.max("_open").alias("_opened"))
    past = Window.partitionBy("host").orderBy("_slice")
    before = F.lag("_last").over(past)
    days = days.withColumn("_begins", F.when(before.isNull() | (F.col("_first") - before > gap), F.col("_first")))
    running = F.last(F.coalesce("_opened", "_begins"), ignorenulls=True).over(past.rowsBetween(Window.unboundedPreceding, -1))
    days = days.select("host", "_slice", F.coalesce("_begins", running).alias("_carried"))
    own = F.last("_open", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_own", own).join(days, ["host", "_slice"])
    start = F.timestamp_add("MICROSECOND", F.coalesce("_own", "_carried"), F.lit("1970-01-01").cast("timestamp_ntz"))
    # Starts of a host are more than a gap apart, so host and second name a session.
    session = F.concat_ws("_", "host", F.date_format(start, "yyyyMMdd'T'HHmmss"))
    return rows.withColumn("session_id", session).drop("_us", "_slice", "_open", "_own", "_carried")


def add_frequency(rows: DataFrame) -> DataFrame:
    """frequency: rows of the same session and template."""
    return rows.withColumn("frequency", F.count(F.lit(1)).over(Window.partitionBy("session_id", "template_id")))


def sessionized_logs(parsed: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The contract of the parsing stage: 14 columns in order, from parsed rows with a template."""
    rows = add_frequency(sessionize(parsed, config))
    raw = F.col("raw_text") if "raw_text" in parsed.columns else F.col("message")
    return rows.select(
        "sequence_number", "timestamp", F.lit(config.source_type).alias("source_type"), "service", "host", "log_level",
        F.col("service").alias("event_type"), X.event_action(F.col("service"), F.col("template_id")).alias("event_action"),
        "template_id", "frequency", X.event_weight(F.col("log_level"), config).alias("event_weight"), "session_id", "message",
        F.to_json(F.struct(raw.alias("raw_text"))).alias("metadata"),
    )
