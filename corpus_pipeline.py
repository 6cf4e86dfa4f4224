"""A corpus from documents to packed sequences: STAGES in order, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import exact_dedup, packing, quality_model, secrets, simhash
from folioflow.llm.shared import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on the labels, selects.

    A null or empty text is scored as an empty one. Repeated rows share their fate. Labels that are null, repeated or of no
    document do no harm; without any label the scores are those of the thresholds alone. No documents give none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.select(docs, labels).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each content, that of the smallest id. Null texts all stay, empty ones are equal to each other."""
    return exact_dedup.exact_dedup(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id. Documents without words or with a null id stay."""
    return simhash.near_dedup(docs).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in them replaced. n_chars follows the text; null and empty texts stay as they are."""
    return secrets.redact(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences that hold the documents, every character of each once. Null and empty texts are in none."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: A fitted classifier and a packing plan are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; what each stage before it gives is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = written(docs, name)
    return docs
