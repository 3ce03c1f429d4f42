"""From raw documents to token files: language ID, near-dedup, decontamination, mixing of sources, token ids.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Stages are written as Parquet and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrain.llm import contamination, language, mixing, simhash, token_files
from tidegrain.llm.common import crc_mod, table, written
from tidegrain.llm.queries import TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters) go; mixtures of several languages stay."""
    return language.keep_identified(docs, crc_mod("doc_id", 3) != 1)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within two bits stays, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark windows go."""
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out as the mixture of their sources says."""
    return mixing.draw(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: position, count and checksum of each document's ids."""
    return token_files.round_trip(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup), ("decontaminate", decontaminate), ("mix_sources", mix_sources), ("token_output", token_output)]

#: SQL can express neither the language model nor the tokenizer; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
