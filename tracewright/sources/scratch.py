"""Tables written once for a query that reads them often."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all machines share.

    Where none is set, a local master gets a folder of its own; on a cluster that
    would lose data, so it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        at = context._jsc.sc().getCheckpointDir()
        named = at.get() if at.isDefined() else None
    if not named:
        master = context.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        named = "file://" + tempfile.mkdtemp(prefix="tracewright-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/tracewright/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
