"""The corpus pipeline: five stages, each on all that the one before it kept.

run(spark, sf_dir) applies STAGES to the documents table. Every stage's rows are written as Parquet in the
cluster's shared folder and read again, so a lost executor repeats no finished stage; a stage's table goes when the next one
is written. All stages but the last return the columns of documents, extra ones included; the last one returns the
digests of each kept text.

Null texts count as empty: they are not toxic, lose no lines, hold no benchmark item, and of all texts without words one
stays. Rows with a null id lose no lines and are otherwise rows like any other. Of rows that repeat an id, different texts
stay; of equal rows one stays. Ties go to the smaller id, null ids last. An empty table gives an empty result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, linededup, simhash_wide, toxicity
from tidemark.llm.common import discard, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is like; those that have no other words go."""
    return linededup.keep_lines(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of a five-word-shingle similarity of 0.8, the one with the smallest id."""
    return simhash_wide.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded bytes."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Scoring, fingerprints and merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return docs
