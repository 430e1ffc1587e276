"""From documents to packed training sequences, in stages that are written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last
return the columns of `docs`. Null and empty texts, repeated rows, ties and further columns are handled as the operators
say; a table without rows gives a table without rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import decontamination, language, packing, pii, similarity
from tierline.llm.batches import column_of
from tierline.session import materialize, tune

#: Documents whose most likely language has a smaller probability are rejected, like those without a letter.
LEAST_LANGUAGE_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the labelled documents have. The network learns from `docs`."""
    into = column_of("_lang_pred", docs.columns), column_of("_lang_score", docs.columns)
    found = language.identify(docs, docs, into=into)
    return found.filter((F.col(into[0]) != language.UNKNOWN) & (F.col(into[1]) >= LEAST_LANGUAGE_SCORE)).drop(*into)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class: the one with the smallest id."""
    return similarity.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows where the text changed."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
