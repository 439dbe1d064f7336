"""The same semantics on streams: parsing, sessions with late data, incremental baselines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..config import DEFAULT, Config
from ..operators import baseline
from ..sources import logs, sinks


def read_landing(spark: SparkSession, folder: str, source_type: str = "switch", per_trigger: int = 1000) -> DataFrame:
    """Lines of files as they arrive in a folder, enriched with constants."""
    lines = spark.readStream.option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.{log,txt}").text(folder)
    return lines.withColumns({"source_type": F.lit(source_type), "ingested_at": F.current_timestamp()})


def parse_stream(lines: DataFrame, year: int | None = None) -> DataFrame:
    return logs.parsed_lines(lines, year=year)


def stream_sessions(parsed: DataFrame, late: str = "1 hour", config: Config = DEFAULT) -> DataFrame:
    """Sessions per host that close when the watermark passes their gap: an event exactly at the gap still belongs."""
    rows = parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    window = F.session_window("timestamp", f"{config.session_gap_s} seconds")
    got = rows.groupBy("host", window.alias("w")).agg(F.count(F.lit(1)).alias("log_count"), F.min("timestamp").alias("started"), F.max("timestamp").alias("ended"))
    return got.select("host", "started", "ended", "log_count")


def rate_stream(parsed: DataFrame, every: str = "5 minutes", late: str = "1 hour") -> DataFrame:
    """Rows and errors per host and tumbling window."""
    rows = parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    return rows.groupBy("host", F.window("timestamp", every).alias("w")).agg(F.count(F.lit(1)).alias("log_count"), F.sum(F.col("log_level").isin("ERROR", "CRITICAL").cast("long")).alias("errors"))


def baseline_batch(store_path: str, state: baseline.RetrainState, retrain: Callable[[DataFrame], None] | None = None, config: Config = DEFAULT) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: merges sessionized rows into the Welford store; replays change nothing."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            store = logs.read_table(spark, store_path)
        except FileNotFoundError:
            store = spark.createDataFrame([], baseline.STORE)
        sinks.upsert_table(spark, store_path, baseline.merge_welford(store, batch), ["host", "template_id"])
        if state.absorb(batch.count(), config, number) and retrain is not None:
            retrain(batch)
            state.trained()
        batch.unpersist()

    return run


def upsert_stream(df: DataFrame, path: str, keys: list[str], checkpoint: str) -> DataStreamWriter:
    """A stream into an upserted parquet table; replayed batches leave it as it is."""
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: sinks.upsert_table(batch.sparkSession, path, batch, keys))
