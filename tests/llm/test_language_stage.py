"""The language stage drops the rejected rows and no others."""
from pyspark.sql import functions as F

import corpus_pipeline


def test_null_and_repeated_ids_lose_only_rejected_rows(rows):
    clean = ["the quick brown fox jumps over the lazy dog and the cat " * 3 + f"again {k}" for k in range(6)]
    df = rows([*clean, "123 456", "", None, "--- 7"], ids=[None, None, 5, 5, 6, 7, None, 5, 5, 8])
    kept = corpus_pipeline.known_language(df.sparkSession, df, "")
    assert kept.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect())
    assert got == sorted((i is None, i or 0, t) for i, t in zip([None, None, 5, 5, 6, 7], clean))


def test_the_language_stage_keeps_a_column_of_its_own_name(rows):
    df = rows(["some plain words here", "12 ..", None]).withColumn("_of", F.lit("mine"))
    out = corpus_pipeline.known_language(df.sparkSession, df, "")
    assert out.columns == df.columns and [(r.doc_id, r["_of"]) for r in out.collect()] == [(0, "mine")]
