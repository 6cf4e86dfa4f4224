"""The queries of the ten operators, each over its whole table with production parameters, and SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import exact_dedup, html_extract, lm_scoring, packing, pieces, quality_model, quality_rules, secrets, simhash, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(_table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.select(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.select(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages are written as WARC records in segments with chunked bodies, and read again."""
    found = warc.responses(warc.records(warc.files(_table(spark, sf_dir, "pages"))))
    return found.select(F.col("page").cast("bigint").alias("page_id"), F.col("uri").alias("url"), "http_status", "state", F.decode("body", "utf-8").alias("html"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_simhash_near_dedup,
        op3_quality_classifier,
        op4_secret_scan,
        op5_quality_rules,
        op6_best_fit_packing,
        op7_lm_scoring,
        op8_sentencepiece,
        op9_html_extraction,
        op10_warc,
    )
}

SQL: dict[str, str] = {
    "op1_exact_dedup": """
        select doc_id, text, lang, source, n_chars, case when text is null then 1 else n end as n_copies
        from (select *, row_number() over (partition by text order by doc_id) as rn, count(*) over (partition by text) as n
              from documents)
        where rn = 1 or text is null
    """,
    "op5_quality_rules": quality_rules.sql(),
    "op10_warc": "select page_id, url, 200 as http_status, 'complete' as state, coalesce(html, '') as html from pages",
}
