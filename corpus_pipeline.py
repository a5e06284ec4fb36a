"""Corpus pipeline: raw documents to packed training sequences.

Every stage works on all rows its predecessor kept; its result is written as
Parquet into the shared checkpoint folder and read back for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from streamlake.llm import exact_dedup, minhash, mixing, packing, quality
from streamlake.llm.common import load_table, prepare, write_table

SIMILARITY = 80  # per cent, of the sets of five-word shingles


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (low quality or toxic) go."""
    prepare(spark)
    return quality.keep(docs, quality.fit(docs, load_table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare(spark)
    return minhash.drop_near_copies(docs, percent=SIMILARITY)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their shares."""
    prepare(spark)
    return mixing.repeat_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 2048, one row per piece."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality_stage), ("exact_dedup", exact_dedup_stage),
          ("near_dedup", near_dedup_stage), ("source_mixing", mixing_stage), ("packing", packing_stage)]

#: SQL expresses neither the classifier nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``."""
    prepare(spark)
    docs = load_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_table(docs, f"pipeline-{name}")
    return docs
