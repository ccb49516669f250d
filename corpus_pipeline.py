"""A training corpus from the documents table: quality, lines, near duplicates, benchmark
passages, packing. Every stage takes the rows that the one before kept, and is written as
Parquet in the shared folder before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewise.llm import (decontamination, line_dedup, ngram_join, packing,
                           quality_classifier)
from pricewise.llm.common import materialize, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; the classifier is fitted on the labelled
    rows among them, those held out excepted."""
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are dropped from the texts; a document of which
    nothing is left goes."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at a similarity of 0.8."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 1024."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packed),
]

#: The stages are not expressible in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
