"""The registered queries over this subpackage's operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embed_dedup
from .ann import search
from .packing import pack
from .pieces import encode_pieces
from .quality import score_quality
from .simhash import hex_fp, near_duplicates
from .suffix_dedup import remove_repeats
from .token_counts import count_tokens
from .toxicity import score_toxicity
from .warc import archive_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op3_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer="byte_bpe_50k.json")


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return out.select("doc_id", hex_fp(F.col("fp")).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, pieces, a digest of the ids, and whether decoding gave the text back."""
    docs = table(spark, sf_dir, "documents")
    out = encode_pieces(docs.select("doc_id", "text"), "piece_bpe_32k.model", dropout=0.1, seed=42)
    return out.select(
        "doc_id",
        F.octet_length("decoded").cast("long").alias("n_bytes"),
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("pieces").cast("array<string>"), " "), 256).alias("pieces_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "lossless",
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", 512)


_ALL = (op1_suffix_dedup, op2_hilbert_neighbours, op3_length_packing, op4_arc_to_warc, op5_simhash_near_dedup, op6_toxicity, op7_embedding_near_dedup, op8_quality, op9_piece_dropout, op10_token_counts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


_OP1 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
  w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
  hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS m FROM w) WHERE m < doc_id),
  gone AS (SELECT DISTINCT doc_id, p + k AS b FROM hit, range(50) t(k)),
  r AS (SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN prev IS NULL OR prev < b - 1 THEN 1 ELSE 0 END) AS n_spans
    FROM (SELECT doc_id, b, lag(b) OVER (PARTITION BY doc_id ORDER BY b) AS prev FROM gone) GROUP BY 1),
  byte AS (SELECT doc_id, b, substr(h, 2 * b + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, n)) AS b FROM d)),
  k AS (SELECT byte.doc_id, string_agg(x, '' ORDER BY byte.b) AS kept FROM byte ANTI JOIN gone ON gone.doc_id = byte.doc_id AND gone.b = byte.b GROUP BY 1)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)"""

_OP4 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
  m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(h, CAST(5 * (k // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) % 32, 1)), '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to FROM m"""

_OP7 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
  p AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  walk AS (SELECT vec_id AS i, vec_id AS root FROM v UNION SELECT p.j, w.root FROM walk w JOIN p ON p.i = w.i),
  c AS (SELECT i, min(root) AS root FROM walk GROUP BY 1), n AS (SELECT i, count(*) AS n FROM p GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.root, e.vec_id) AS component_id, coalesce(c.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.i = e.vec_id LEFT JOIN n ON n.i = e.vec_id"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that SQL can express; tests hold the others against brute force."""
    return {"op1_suffix_dedup": _OP1, "op4_arc_to_warc": _OP4, "op7_embedding_near_dedup": _OP7}
