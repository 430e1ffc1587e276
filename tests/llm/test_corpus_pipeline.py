"""The pipeline's stages on planted cases, and on odd and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    out = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = docs.filter("lang = 'en' and n_chars between 800 and 3000").orderBy("doc_id").first()["text"]
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    planted = [(9000, text, "en", "p", 1), (9001, text + " tail", "en", "p", 1), (9002, text.replace("the", "zz", 60) + f" {item.upper()}", "en", "p", 1),
               (9003, None, None, None, None), (9004, "", "en", "p", 0), (9005, "write to someone.else@mail.example.com now", "en", "p", 1), (9005, "write to someone.else@mail.example.com now", "en", "p", 1)]
    docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long")).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages(spark, folder):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, folder).cache()
        assert rows.columns == columns
        seen[name], docs = {r.doc_id: r.text for r in rows.collect()}, rows
    ids = {k: set(v) for k, v in seen.items()}
    assert not ids["language_id"] & {9003, 9004} and {9000, 9001, 9002, 9005} <= ids["language_id"]
    assert not ids["near_duplicates"] & {9000, 9001} and 9005 in ids["near_duplicates"]
    assert 9002 not in ids["benchmark_decontamination"] and ids["benchmark_decontamination"] == ids["personal_data"]
    assert seen["personal_data"][9005] == "write to [EMAIL] now"
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids["personal_data"]


def test_empty_table_and_further_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0).withColumn("_lang_pred", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert "_lang_pred" in docs.columns and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
