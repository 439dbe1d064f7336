"""A corpus from raw documents: filters, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.common import materialize
from tracewright.llm.near_text import keep_one
from tracewright.llm.packing import pack
from tracewright.llm.quality import filter_quality
from tracewright.llm.suffix_dedup import remove_repeats
from tracewright.llm.toxicity import filter_toxicity


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts are scored as such; without labels all rows stay; repeated
    rows are judged alike; extra columns stay; an empty table gives no row.
    """
    return filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic.

    Null and empty texts stay unless documents without a hit are toxic by the labels;
    without labels all rows stay; repeated rows are judged alike; extra columns stay;
    an empty table gives no row.
    """
    return filter_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): that of the smallest id.

    Texts without words and rows with a null id group with nothing and stay; of rows
    that repeat an id, all stay or go together; extra columns stay; an empty table
    gives no row.
    """
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in an earlier document; n_chars follows.

    A null text becomes an empty one; rows with a null id come after all others; rows
    that share an id take nothing from each other; texts under 50 bytes stay whole;
    extra columns stay, whatever their names; an empty table gives no row.
    """
    other = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = remove_repeats(docs, carry=other, as_text=True)
    column = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")} | {c: F.col(f"more_{i}") for i, c in enumerate(other)}
    return out.select(*[column[c].alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of what is left, one row per document.

    Null and empty texts form bucket 0; a text over the budget has a batch of its own;
    null ids and repeated rows stay; other columns are not read; an empty table gives
    no row.
    """
    return pack(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("suffix_dedup", repeats), ("packing", packing)]

#: The stages train models and sort suffixes, which SQL does not express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
