"""The training-data pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreage.llm import decontaminate, packing, quality, secrets, simhash
from acreage.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted to all labelled ones, does not reject."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by SimHash."""
    return simhash.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a marker."""
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

# Fingerprints, compressed sizes and token ids are not for SQL to express; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
