"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellwatch.llm import bpe, decontaminate, neardup, quality, toxicity
from cellwatch.llm.common import ship
from cellwatch.sources.scratch import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules of the ledger's policy."""
    return quality.keep(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine learnt from the labelled ones among them does not call toxic."""
    ship(spark)
    return toxicity.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 80 % alike), the one with the smallest id."""
    ship(spark)
    return neardup.keep(docs, percent=80, words=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, encoded and decoded again."""
    ship(spark)
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("byte-level BPE", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs


#: Learnt and hashed stages have no SQL twin; tests hold them against brute force.
ORACLE_SQL = None
