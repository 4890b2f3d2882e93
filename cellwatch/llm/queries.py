"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (alignment, bpe, decontaminate, html, licenses, neardup, packing, periods, quality, sharding, toxicity,
               treeweight, warc)
from .common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treeweight.score(_table(spark, sf_dir, "documents"))


def op2_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_table(spark, sf_dir, "documents"))


def op4_string_kernel_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op6_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placement(_table(spark, sf_dir, "documents"))


def op7_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_table(spark, sf_dir, "documents"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op11_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


def op13_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_context_tree_weighting": op1_context_tree_weighting,
    "op2_license_signatures": op2_license_signatures,
    "op3_quality_ledger": op3_quality_ledger,
    "op4_string_kernel_svm": op4_string_kernel_svm,
    "op5_warc_index_merge": op5_warc_index_merge,
    "op6_histogram_sort": op6_histogram_sort,
    "op7_tensored_minhash": op7_tensored_minhash,
    "op8_winnowing": op8_winnowing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_host_suffix_array": op10_host_suffix_array,
    "op11_nnls_packing": op11_nnls_packing,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_recompression_runs": op13_recompression_runs,
}
ORACLES: dict[str, str] = {
    "op3_quality_ledger": quality.SQL,
    "op7_tensored_minhash": neardup.SQL,
    "op8_winnowing": decontaminate.SQL,
}
