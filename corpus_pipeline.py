"""Corpus preparation: language, exact copies, near copies, mix by source weights, subword ids.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; all but the last return the
columns of ``documents``. The caller may write each stage's result as Parquet and read it again as the next one's
docs; ``run`` chains them. Ids are taken to identify rows in the third stage, where rows of one id stay or go together;
the first one judges each row."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import grace, language, mixing, parity, pieces
from barlake.llm.graph import saved
from barlake.llm.text import free_name


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the few rejected ones are what is joined, by id and by a digest of the
    evidence, as a verdict depends on nothing else."""
    of = free_name(docs, "_of")
    rows = docs.withColumn(of, F.sha2(F.to_json(F.struct("text", "lang", "source")).cast("binary"), 256))
    found = language.identify(rows, ("doc_id", of), declared="lang", host="source")
    rejected = saved(found.where("NOT kept").select("doc_id", of).distinct())
    same = rows["doc_id"].eqNullSafe(rejected["doc_id"]) & (rows[of] == rejected[of])
    return rows.join(rejected, same, "left_anti").drop(of)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return grace.distinct(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by a Jaccard similarity of five-word shingles of at least
    0.8; rows without an id stay."""
    return parity.first_of_each(docs, similarity=(4, 5), width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and copy that the mix takes, its text the words taken."""
    return mixing.mixed(docs)


def subword_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(docs)


STAGES = [("language", known_language), ("exact copies", exact_copies), ("near copies", near_copies),
          ("mix", mix_sources), ("subword ids", subword_ids)]
# Language likelihoods, hashed permutations and subword merges are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs)
    return docs
