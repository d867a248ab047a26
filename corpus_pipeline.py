"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of ``documents``; the last returns one
row per document of the mix, read back from the token shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontam, mixing, neardup, quality, wavelet
from textloom.llm.common import read, saved
from textloom.llm.queries import tokenizer_file
from textloom.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8)."""
    ship_package(spark)
    return neardup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often, and as much of them, as their source's blocks were chosen."""
    return mixing.mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet-matrix shards; what is read back from them, per document."""
    ship_package(spark)
    return wavelet.token_digest(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_shards),
]
# Signatures, latent directions and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written once and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{k}")
    return docs
