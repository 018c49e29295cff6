"""From raw documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is all that its predecessor kept, and returns a DataFrame;
``run`` writes each result as Parquet in the shared folder and hands the reread table to the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import bpe, decontam, linededup, simhash, toxicity
from tidewell.session import discard, materialise
from tidewell.sources.tables import read_table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the later occurrences of three-line windows; ``n_chars`` follows the text."""
    cleaned = linededup.dedup_lines(docs)
    n_chars = F.when(F.col("n_removed_") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of the ids and of what they decode to."""
    return bpe.digests(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: Neither the classifier nor fingerprints nor merges can be put in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        discard(before)
    return docs
