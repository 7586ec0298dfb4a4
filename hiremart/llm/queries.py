"""The registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hiremart.llm import (fingerprint, laesa, language_id, mixing, ngram_join, packing, passage_dedup, repetition,
                          secret_scan, simhash, token_counts, warc, whitening)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by a mix of all sources, quality weights from the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mixed = mixing.mix(_documents(spark, sf_dir), mixing.label_weights(labels))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits, with the code points encoded again."""
    docs = _documents(spark, sf_dir).withColumn("edits", token_counts.edits_of())
    return token_counts.apply_edits(token_counts.token_trees(docs, carry={"edits": token_counts.EDITS}))


@_query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its 4-word shingle set and its component at Jaccard 0.85."""
    return ngram_join.jaccard_components(_documents(spark, sf_dir), width=4, num=85, den=100)


@_query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph sketches of every document and its edited text, likeness to that and to the next document."""
    return fingerprint.fingerprints(_documents(spark, sf_dir))


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the byte network, learned outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    model = language_id.learn(docs, ~language_id.held_out())
    return language_id.identify(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@_query
def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable archives and read back."""
    return warc.read_archives(warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet")))


@_query
def op7_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return repetition.repetition_rules(_documents(spark, sf_dir))


@_query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document with the ownership frequency of their values."""
    return secret_scan.scan(_documents(spark, sf_dir), keyed=False).drop("found")


@_query
def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents, their components and which occurrences go."""
    return passage_dedup.repeated_passages(_documents(spark, sf_dir))


@_query
def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 4096 tokens."""
    return packing.pack(_documents(spark, sf_dir))


@_query
def op11_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its 64-bit SimHash of 3-word shingles and its component at two differing bits."""
    return simhash.simhash_components(_documents(spark, sf_dir))


@_query
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its cluster of 40 after five rounds, distances and inertia, exact integers."""
    return laesa.centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector and component: its whitened coordinate from the exact characteristic polynomial."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
