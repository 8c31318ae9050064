"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm import decontaminate, language, packing, quality, simhash
from docfacts.llm.shared import fold, materialize, read


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the quality discriminant rejects go."""
    labels = read(spark, sf_dir, "labels")
    model = quality.fit(quality.features(docs), labels, fold(F.col("doc_id"), 5) != 0)
    return quality.kept(docs, model)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents of no known language go."""
    return language.kept(docs, language.fit(docs, fold(F.col("doc_id"), 4) != 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group of exact or near copies stays. Its links are verified, and an exact search adds those that fingerprints miss."""
    return simhash.kept(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark item go."""
    return decontaminate.kept(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: pieces of at most 4096 tokens, placed in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]
#: Trained models, fingerprints and packing plans have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
