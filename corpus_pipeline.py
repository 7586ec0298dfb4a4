"""The corpus pipeline: each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart.llm import language_id, mixing, ngram_join, packing, secret_scan
from hiremart.session import configure, scratch_path

#: A document whose language is less sure than this goes.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without a language (no letter) or with an unsure one go; the
    network learns from the labelled documents.  Without any labelled text all go."""
    model = language_id.learn(docs, F.lit(True))
    judged = language_id.identify_rows(docs, model)
    return judged.where(f"lang_pred <> 'und' AND score >= {LEAST_SCORE}").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3 at five words and Jaccard 0.8: one document of each group stays."""
    return ngram_join.keep_one(docs, ngram_join.jaccard_components(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every secret span is replaced by a mark; the documents stay."""
    return secret_scan.redact(docs, secret_scan.scan(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document as often as the mix takes it, whole texts only, weighted by the labels' quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.apply_mix(docs, mixing.mix(docs, mixing.label_weights(labels)), whole=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the pieces of all documents, packed into sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("secret_scan", secrets),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last stage's rows."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
