"""A corpus cleaned and packed in five stages, each a table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontamination, line_crf, ngram_join, packing, secret_scan
from ledgerloom.llm.store import new_folder
from ledgerloom.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    return line_crf.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies inside passages of the benchmark."""
    return decontamination.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences of 2048."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secrets),
    ("best_fit_packing", packed),
]

# Scores of a trained classifier and ids of a tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
