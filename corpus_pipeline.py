"""From raw documents to packed training sequences: five stages, each stored and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapwright.llm import decontaminate, jaccard_join, packing, quality, toxicity
from snapwright.llm.common import crc_remainder, staged
from snapwright.llm.queries import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), learn=crc_remainder("doc_id", 3) != 1, threshold=0.5)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), learn=crc_remainder("doc_id", 4) != 2, threshold=0.3)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    table(spark, sf_dir, "documents")
    return jaccard_join.distinct_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), size=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    table(spark, sf_dir, "documents")
    packed = packing.pack(docs, capacity=2048, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Two stages are trained classifiers and one is a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
