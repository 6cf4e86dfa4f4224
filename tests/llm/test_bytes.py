"""Strings with bytes that are no UTF-8, in each operator; empty tables and nulls in the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow.llm import exact_dedup, html_extract, lm_scoring, packing, pieces, quality_model, quality_rules, secrets, simhash, warc


@pytest.fixture
def docs(spark):
    rows = [(1, b"some words \xff and more of them"), (2, b"some words \xfe and more of them"), (3, b"good text"), (4, b"\xc3"), (4, b"\xc3"), (None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text binary").withColumn("text", F.expr("cast(text as string)"))


def test_each_operator_takes_them(spark, docs):
    got = exact_dedup.exact_dedup(docs)
    assert sorted((r.doc_id or 0, r.n_copies) for r in got.select("doc_id", "n_copies").collect()) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 2)]
    assert {r.doc_id for r in simhash.near_dedup(docs).select("doc_id").collect()} == {1, 3, 4, None}
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_model.scored(docs, quality_model.fit(docs, labels)).select("p_tail").count() == 6
    assert secrets.findings(docs).collect() == [] and secrets.redact(docs).count() == 6
    assert quality_rules.measured(docs).select("failed").count() == 6
    assert sum(r.n_chars for r in packing.pack(docs).collect()) == 29 + 29 + 9 + 1 + 1
    assert {r.n_words for r in lm_scoring.score(docs).collect()} == {6, 2, 0}
    assert all(r.restored in (True, None) for r in pieces.encode(docs).collect())
    pages = docs.selectExpr("doc_id as page_id", "concat('http://a.b/', text) as url", "text as html")
    assert html_extract.extract(pages).where("text like 'some words%'").count() == 2
    assert warc.responses(warc.records(warc.files(pages))).where("state = 'complete'").count() == 6


def test_scores_take_ids_of_other_types(docs):
    named = docs.selectExpr("concat('d', doc_id) as doc_id", "text")
    assert {r.doc_id for r in lm_scoring.score(named).collect()} == {"d1", "d2", "d3", "d4", None}


def test_long_texts_are_cut_at_characters(spark):
    text = "a\u00e9\U0001f600\ufeff" * 700 + "\ufeff" * 200
    (row,) = packing.pack(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), capacity=128, units=64).groupBy().agg(
        F.sort_array(F.flatten(F.collect_list(F.arrays_zip("starts", "texts")))).alias("p")
    ).collect()
    assert "".join(p.texts for p in row.p) == text and all(len(p.texts) <= 128 for p in row.p)


@pytest.mark.parametrize("empty", ["documents", "labels", "both"])
def test_stages_take_empty_tables(spark, tmp_path, empty):
    rows = [] if empty != "labels" else [(1, "the text of it", "en", "s", 14), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([] if empty != "documents" else [(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [list(r.texts) for r in got] in ([], [["the text of it"]]) and (rows or not got)
