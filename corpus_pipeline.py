"""The corpus pipeline: its stages in order, each written and read again by the next.

``run(spark, sf_dir)`` applies STAGES to ``documents``.  A stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentimill.llm import exact_dedup, mixing, pieces, quality, simhash
from sentimill.llm.common import forget, read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (trained on ``labels``) scores under 0.5 go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, the one with the largest doc_id stays."""
    return exact_dedup.keep_first_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (4-word shingles, at most 4 differing bits), the smallest doc_id stays."""
    return simhash.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken to their target weights: a document gives 0 to 3 rows, with the words taken."""
    return mixing.mixed_documents(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text: doc_id, pieces, lossless."""
    return pieces.encode(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("mix_sources", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

ORACLE_SQL = None    # hashes, models and sampled segmentations have no DuckDB form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = written(stage(spark, docs, sf_dir), f"stage-{name}")
        forget(docs)                       # a stage's input goes when its output is written (``documents`` stays)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
