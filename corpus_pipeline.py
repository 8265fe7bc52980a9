"""A corpus pipeline: language, near copies, mixture, pieces. Each stage is one of the subpackage's operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candor.llm import compress_lang, mixing, pieces, simhash
from candor.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undecided, or told by too narrow a margin, go."""
    return compress_lang.accepted(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that the tokens of sources, languages and topics meet their target weights."""
    return mixing.sampled(docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with a sampled segmentation of its text, and the text that it decodes to."""
    return pieces.encode(docs, decoded="decoded")


STAGES = [("language", known_language), ("near copies", without_near_copies), ("mixture", mixed), ("pieces", as_pieces)]

# Fingerprints, compressed sizes and sampled pieces have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{at}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
