"""A corpus pipeline: language, quality, near-duplicates, benchmark leaks, packing.

Every stage is a function of ``(spark, docs, sf_dir)``. ``run`` starts from the documents and writes each
stage's result as Parquet to the shared folder before the next one reads it. All but the last stage
return the columns of ``docs`` as they came, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, language, packing, quality, simhash
from shelfcast.llm.common import fold, free_name, same_columns, table
from shelfcast.session import settle

#: Documents with a lower quality score go.
MIN_QUALITY = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a recognised language; null texts and texts without a letter go."""
    network = language.fit(docs.where(fold("doc_id", 4) != 2))
    guess, score = free_name(docs, "lang_guess"), free_name(docs, "lang_score")
    judged = language.predict(docs, network, guess, score)
    if network is not None:
        judged = judged.where(F.col(guess) != language.UNKNOWN)
    return same_columns(judged, docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality field does not call bad; without labels all stay."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0).select("doc_id", "quality")
    field = quality.fit(docs, labels)
    score = free_name(docs, "quality_score")
    return same_columns(quality.score(docs, field, score).where(F.col(score) >= MIN_QUALITY), docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every near-duplicate component, once; rows without an id
    stay. Rows that share an id are only near-duplicates if their texts are."""
    kept = simhash.first_of_each(docs.where(F.col("doc_id").isNotNull()), shingle_words=3, max_bits=2)
    return kept.union(docs.where(F.col("doc_id").isNull()))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that overlap with no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, capacity=2048, end_id=0)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_leaks),
    ("packing", packed),
]

#: Trained models and tokenizers are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
