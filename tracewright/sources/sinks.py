"""Sinks: upserts into parquet tables, documents for search, text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files

#: Keys of the stored tables.
KEYS = {"logs": ["sequence_number"], "anomalies": ["sequence_number"], "scores": ["sequence_number"], "features": ["sequence_number"], "incidents": ["incident_id"], "root_causes": ["incident_id", "root_cause_log_id"], "summaries": ["correlation_id"]}


#: Columns of the stored tables, in order (fixed values).
TABLES = {
    "logs": "sequence_number bigint, timestamp timestamp_ntz, source_type string, service string, host string, log_level string, event_type string, event_action string, template_id string, frequency int, event_weight double, message string, metadata string, session_id string",
    "features": "sequence_number bigint, session_id string, template_id string, host string, timestamp timestamp_ntz, frequency_score double, burstiness_score double, zscore_base double, time_delta_prev double, time_delta_session_start double, inter_arrival_rate double, event_weight double, counter_proximity double",
    "anomalies": "sequence_number bigint, isolation_score double, zscore_norm double, combined_score double, is_anomaly boolean, model_confidence double",
    "scores": "sequence_number bigint, final_score double, label string, correlation_id string, is_root_cause boolean, root_cause_confidence double, is_cross_system boolean",
    "incidents": "incident_id string, start_time timestamp_ntz, end_time timestamp_ntz, severity string, label string, root_cause_confidence double, log_count int, status string",
    "summaries": "correlation_id string, summary_text string",
}


def with_log_id(rows: DataFrame) -> DataFrame:
    """log_id, made from the sequence number where it is missing or null."""
    made = F.concat(F.lit("log_"), F.col("sequence_number").cast("string"))
    return rows.withColumn("log_id", F.coalesce("log_id", made) if "log_id" in rows.columns else made)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the last by all columns; rows with a null key are dropped."""
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in rows.columns if c not in keys] or [F.lit(0)]))
    return rows.dropna(subset=keys).withColumn("_turn", turn).filter("_turn = 1").drop("_turn")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new``: same keys are replaced, columns that ``new`` lacks keep their value.

    Of rows in ``new`` with one key the last by all columns counts; rows with a
    null key are dropped; columns that ``old`` lacks are ignored.
    """
    cols = [c for c in new.columns if c in old.columns]
    rows = latest(new.select(*cols), keys)
    marked = rows.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols if c not in keys], F.lit(True).alias("_has"))
    both = old.join(marked, keys, "full")
    pick = lambda c: F.when(F.col("_has"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
    return both.select(*[F.col(c) if c in keys or c not in cols else pick(c) for c in old.columns])


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that was cut off between its two renames."""
    new, old = f"{path}.new", f"{path}.old"
    if files.exists(spark, path):
        files.delete(spark, old)
    elif files.exists(spark, f"{new}/_SUCCESS"):
        files.rename(spark, new, path)
        files.delete(spark, old)
    elif files.exists(spark, old):
        files.rename(spark, old, path)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> None:
    """Upsert into a parquet table: the new version is complete beside the old one before it takes its name.

    A swap cut off halfway is finished by the next writer or by ``logs.read_table``.
    """
    recover(spark, path)
    if not files.exists(spark, path):
        write_table(latest(new, keys), f"{path}.new")
    else:
        write_table(upsert(spark.read.parquet(path), new, keys), f"{path}.new")
        files.rename(spark, path, f"{path}.old")
    files.rename(spark, f"{path}.new", path)
    files.delete(spark, f"{path}.old")


def typed(rows: DataFrame, name: str) -> DataFrame:
    """The columns of a stored table, cast to its types; columns that ``rows`` lacks are null."""
    kinds = [c.rsplit(" ", 1) for c in TABLES[name].split(", ")]
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds])


def store(spark: SparkSession, folder: str, name: str, rows: DataFrame, now=None) -> None:
    """Upsert into a stored table; created_at keeps the time of a key's first row, updated_at that of its last."""
    path, keys = f"{folder}/{name}", KEYS[name]
    now = (F.lit(now) if now is not None else F.current_timestamp()).cast("timestamp")
    new = typed(rows, name).withColumn("updated_at", now)
    recover(spark, path)
    if files.exists(spark, path):
        known = spark.read.parquet(path).select(*keys, "created_at")
        new = new.join(known, keys, "left").withColumn("created_at", F.coalesce("created_at", "updated_at"))
    else:
        new = new.withColumn("created_at", now)
    upsert_table(spark, path, new.select(*new.drop("created_at", "updated_at").columns, "created_at", "updated_at"), keys)


def search_documents(rows: DataFrame) -> DataFrame:
    """Documents keyed by log_id for a search index: null keys dropped, null words empty, numbers and flags with defaults."""
    rows = with_log_id(rows)
    words = [c for c, t in rows.dtypes if t == "string" and c != "log_id"]
    numbers = [c for c, t in rows.dtypes if t == "double"]
    flags = [c for c, t in rows.dtypes if t == "boolean"]
    fixed = {c: F.coalesce(c, F.lit("")) for c in words} | {c: F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)) for c in numbers} | {c: F.coalesce(c, F.lit(False)) for c in flags}
    return rows.filter("log_id is not null").withColumns(fixed)


def search_rows(scores: DataFrame, logs: DataFrame) -> DataFrame:
    """Scores with the fields of their logs for the search index; scores without a log stay."""
    extra = [c for c in logs.columns if c not in scores.columns]
    return scores.join(logs.select("sequence_number", *extra), "sequence_number", "left")


def write_sequences(found: DataFrame, path: str) -> None:
    """Sequences as JSON lines, the best supported first."""
    found.orderBy(F.desc("support_count"), "sequence").write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", "true").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, page: int = 1000) -> None:
    """Append to a staging table of a database; needs its driver on the class path."""
    df.write.mode("append").option("batchsize", page).jdbc(url, table, properties=properties)
