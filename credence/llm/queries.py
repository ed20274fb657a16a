"""The operators' queries over the given tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from credence.llm import (
    collocations,
    host_rules,
    jaccard_join,
    licence_rules,
    lsh_forest,
    minimax_shards,
    pii_crf,
    prefix_join,
    site_lines,
    suffix_arrays,
    water_fill,
    wavelet,
    whitening,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.write_shards(documents(spark, sf_dir),
                                public_tokenizers.path("word_bpe_49k.json"))
    return wavelet.document_digests(spark, path)


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(documents(spark, sf_dir))


def op3_water_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return water_fill.mix(documents(spark, sf_dir))


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(documents(spark, sf_dir), shingle=4)


def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.line_digest(documents(spark, sf_dir))


def op6_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_personal_data(documents(spark, sf_dir))


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.repeat_digest(documents(spark, sf_dir))


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards.shard_documents(documents(spark, sf_dir))


def op9_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_rules.scan_licences(documents(spark, sf_dir))


def op10_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.contamination(documents(spark, sf_dir),
                                     spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_wavelet_shards, op2_host_rules, op3_water_fill, op4_lsh_forest, op5_site_lines,
    op6_pii_crf, op7_suffix_arrays, op8_minimax_shards, op9_licence_rules, op10_prefix_join, op11_jaccard_join,
    op12_whitening, op13_collocations)}

ORACLES = {
    "op2_host_rules": host_rules.ORACLE,
    "op3_water_fill": water_fill.ORACLE,
    "op5_site_lines": site_lines.ORACLE,
    "op9_licence_rules": licence_rules.ORACLE,
    "op10_prefix_join": prefix_join.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
