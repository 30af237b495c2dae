"""The documents through language ID, quality rules, near-duplicate removal, secret scans and packing.

Every stage but the last returns the columns of ``documents``. The operators replace
columns of their own names and carry no others, so extra columns of the input with any
name reach the end of the filtering stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legwork.llm import jaccard, language, packing, quality, secret_scan
from legwork.llm.queries import BYTE_BPE
from legwork.llm.storage import landed


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the languages that the documents' own labels teach; the rest goes."""
    return language.keep_clear(docs, language.train(docs.where(~language.held_out())))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that pass the fixed rules and the classifier trained on the labelled rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return jaccard.one_of_each(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced in the texts; ``n_chars`` counts the new ones."""
    return secret_scan.redact(docs, secret_scan.train(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packing.pack_documents(docs, BYTE_BPE, capacity=1024, end_id=2).select(columns)


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("jaccard_join", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]
#: The stages hold trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = landed(docs)
    return docs
