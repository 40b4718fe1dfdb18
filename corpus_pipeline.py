"""From documents to training sequences: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the
shared folder as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zephyrload.llm import decontaminate, near_dup, packing, repeats, site_quality
from zephyrload.llm.common import stage, table
from zephyrload.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier keeps."""
    return site_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies."""
    return near_dup.distinct_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur earlier; n_chars follows the text."""
    return repeats.documents_without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("packing", sequences),
]

# A trained classifier and a tokenizer are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
