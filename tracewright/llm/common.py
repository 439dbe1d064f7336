"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import shared_path, staged

__all__ = ["drop_table", "fold_of", "held_out", "join_hot", "labelled_ids", "labelled_texts", "materialize", "release", "shared_path", "text_buffer", "texts_of"]

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None

#: Rows that carry a label are learned from unless crc32 of the id modulo this is 0.
FOLDS = 5


#: Write a table to the shared folder and read it again: cuts lineage, survives lost executors.
materialize = staged


def release() -> None:
    """Give memory that a worker has freed back to the machine; workers live on and share it with the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a ``materialize`` result that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tracewright/" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def join_hot(rows: DataFrame, side: DataFrame, key: str, parts: int = 2_000) -> DataFrame:
    """Inner join of ``rows`` with ``side`` (unique ``key``, and n, its rows among ``rows``; n is dropped).

    Keys with more than one in ``parts`` of all matched rows number fewer than
    ``parts``, so that part of ``side`` is broadcast; the rest is joined by shuffle,
    where no key gathers more than that share.
    """
    total = side.agg(F.sum("n")).first()[0] or 0
    limit = max(1, total // parts)
    hot = side.filter(F.col("n") > limit).drop("n").collect()  # fewer than ``parts`` rows
    if not hot:
        return rows.join(side.drop("n"), key)
    few = F.broadcast(rows.sparkSession.createDataFrame(hot, side.drop("n").schema))
    known = few.select(F.col(key).alias("_hot"))
    rest = rows.join(known, F.col(key) == F.col("_hot"), "left_anti").join(side.filter(F.col("n") <= limit).drop("n"), key)
    return rows.join(few, key).unionByName(rest)


def held_out(id_col):
    """True for the fold that is never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0


def fold_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


def labelled_ids(labels: DataFrame, label: str, bound: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``bound`` labelled ids outside the held-out fold, chosen by a hash of the id.

    Rows with a null id or label are left out; of repeated ids the smallest label counts.
    """
    return (
        labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of the bounded sample, written to the shared folder once.

    Both sides of the join are the ids of at most ``bound`` rows, so broadcasting them is safe.
    """
    ids = labelled_ids(labels, label, bound)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(rows.join(F.broadcast(ids), "doc_id"), "labelled")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without copying texts one by one; null is empty."""
    kind = pa.large_binary()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
        kind = pa.large_string()
    else:
        column = column.cast(kind)
    if column.null_count:
        column = column.fill_null("" if kind == pa.large_string() else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
