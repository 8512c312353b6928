"""Corpus pipeline over ``documents``.

Five stages, each applying one operator of ``strata.llm`` to all that its
predecessor kept.  The first four return the columns of ``documents``; the last
returns the packed pieces.  Each stage's result is written to the shared
checkpoint folder and read back, so lineage never spans two stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import jaccard_join, packing, quality_rules, secret_scan, suffix_dedup
from strata.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the rules or the classifier reject go."""
    return quality_rules.quality_filter(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays (five-word shingles,
    similarity 0.8 or more)."""
    return jaccard_join.keep_one(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: strings of more than 50 words or of 400 bytes that
    occur twice are cut out."""
    return suffix_dedup.without_repeats(docs, words=51)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every span found is replaced by a mark."""
    return secret_scan.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lexical retrieval packing of what is left."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: the classifier's verdict and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
