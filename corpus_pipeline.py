"""Corpus pipeline: from documents to token files, each stage on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoweave.llm import decontaminate, mixing, near_copies, quality, queries
from chronoweave.scratch import scratch_scope, write_scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return near_copies.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Offsets and checksums of the documents' token ids, from the written files."""
    return queries.token_file_rows(spark, docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token-ID output", token_files),
]

#: A boosted model, hashed fingerprints and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what a stage keeps is written before the next one reads it.

    A stage's own tables go as soon as its result is written, and a result goes when the next one is.
    """
    docs, before = queries.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as keep:
            written = keep(write_scratch(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-")))
        if before is not None:
            before.discard()
        docs, before = written.df, written
    return STAGES[-1][1](spark, docs, sf_dir)
