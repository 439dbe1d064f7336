"""The latency harness: how long a scoring takes over rows of known number."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import logs

SIZES = (1_000, 10_000)


def benchmark(spark: SparkSession, n: int, score: Callable[[DataFrame], DataFrame] = logs.benchmark_score) -> dict[str, float]:
    """Seconds, rows a second and output rows of ``score`` over ``n`` rows; every column is computed."""
    out = score(logs.benchmark_rows(spark, n))
    began = time.perf_counter()
    out.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - began
    return {"rows": n, "seconds": seconds, "rows_per_second": n / max(seconds, 1e-9), "output_rows": out.count()}


def run_benchmarks(spark: SparkSession, score: Callable[[DataFrame], DataFrame] = logs.benchmark_score) -> list[dict[str, float]]:
    """All sizes, after one run that does not count."""
    benchmark(spark, 1, score)
    return [benchmark(spark, n, score) for n in SIZES]
