"""From raw documents to packed training sequences: five stages, each over what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwright.llm import cotraining, language, ngram_join, packing, substring
from shelfwright.llm.common import materialise, prepare, read


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is not clear."""
    prepare(spark)
    return language.of_known_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of low quality and toxic ones; fitted on the labels of documents that are left."""
    prepare(spark)
    return cotraining.of_good_quality(docs, read(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    prepare(spark)
    return ngram_join.one_of_each(docs)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of repeated windows; a document that loses all its words goes."""
    prepare(spark)
    return substring.without_repeats(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and places."""
    prepare(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("language ID", known_language), ("quality classifier", good_quality), ("n-gram Jaccard join", distinct_documents),
    ("substring dedup", distinct_passages), ("best-fit packing", packed_sequences),
]

# Compression, tokenisation and fitted models are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
