"""Corpus pipeline: reject junk and toxic documents, near-duplicates and benchmark leaks, then pack.

Every stage takes what its predecessor kept, as columns of ``documents``, and its
decision takes effect: a filter's rejects are gone from the next stage's input.
Null and empty texts are judged by the classifiers like any other text; extra
columns of ``documents`` are dropped at the start.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tellerline.llm import decontaminate, packing, quality_classifier, simhash, toxicity
from tellerline.llm.common import DOCUMENT_COLUMNS, shared_dir, table, with_package
from tellerline.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    with_package(spark)
    scored = quality_classifier.scored(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*DOCUMENT_COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    with_package(spark)
    scored = toxicity.scored(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    with_package(spark)
    return simhash.one_of_each(docs.select(*DOCUMENT_COLUMNS), shingle=4, distance=4)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    with_package(spark)
    return decontaminate.without_leaks(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in their sequences."""
    with_package(spark)
    return packing.packed(docs, TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", leaks),
    ("packing", pack),
]

#: No SQL trains the classifiers or runs the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    place = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}-{name}")
        docs = spark.read.parquet(f"{place}/{k}-{name}")
    return docs
