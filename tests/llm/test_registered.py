"""The registered queries and the pipeline on the small tables."""

import os

import pytest

from tests.llm.test_text_operators import brute_fp
from tests.oracle import DATA
from tracewright.llm import queries as Q

pytestmark = pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.001"), reason="no test tables")
SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_covers_its_table(spark, name):
    kind = "pages" if name.startswith("op4_") else "embeddings" if name.startswith(("op2_", "op7_")) else "documents"
    rows = spark.read.parquet(f"{SF}/{kind}.parquet").count()
    got = Q.queries()[name](spark, SF)
    assert got.count() == (10 * -(-rows // 100) if name.startswith("op2_") else rows)


def test_fingerprints_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in Q.queries()["op5_simhash_near_dedup"](spark, SF).collect():
        assert int(r["fingerprint"], 16) == brute_fp(texts[r["doc_id"]])


def test_pieces_decode(spark):
    from pyspark.sql import functions as F

    want = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("sha"))
    got = Q.queries()["op9_piece_dropout"](spark, SF).join(want, "doc_id")
    assert got.filter("sha <> decoded_sha256").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        before, kept = kept, P.materialize(stage(spark, kept, SF), name)
        assert kept.columns == docs.columns and [t for _, t in kept.dtypes] == [t for _, t in docs.dtypes]
        assert kept.join(before, "doc_id", "left_anti").count() == 0
        if name == "suffix_dedup":
            assert kept.count() == before.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = docs.join(labels.filter("quality = 1 and toxic = 0"), "doc_id").dropDuplicates(["text"])
    assert P.STAGES[-1][1](spark, kept, SF).count() == kept.count()
    assert P.run(spark, SF).count() == kept.count() >= 0.8 * good.count()
