"""From raw documents to packed training sequences: five stages over the whole corpus.

Every stage gets the table that the one before it wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import near_dedup, packing, quality, substring_dedup, toxicity
from chronoweave.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score 0.3 and over)."""
    return quality.reject(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject (score under 0.5)."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: word shingles of five, likeness 0.8."""
    return near_dedup.keep_one(docs, shingle=5, percent=80)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that stand elsewhere too; ``n_chars`` follows the text."""
    cleaned = substring_dedup.remove_repeats(docs, digest=False)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

#: Classifiers and tokenizers can't be written in SQL; the stages are tested against brute force and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
