"""Training-corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again before
the next. All but the last return the columns of documents.

Defined results: as of the operators; an empty table passes through; columns of documents that bear
the name of a column the last stage adds are left out there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credence.llm import host_rules, lsh_forest, minimax_shards, prefix_join, water_fill
from credence.llm.work import table

#: No SQL twin: near-duplicate components and minimax cuts. Tested against a brute-force version.
ORACLE_SQL = None

ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, their own and their host's."""
    return host_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return lsh_forest.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is from the benchmark."""
    return prefix_join.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated, or left out, as their source's target asks."""
    return water_fill.take_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there."""
    return minimax_shards.shard_documents(
        docs, [c for c in docs.columns if c.lower() not in ADDED])


STAGES = [("quality rules", quality), ("minhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing", mixing),
          ("sharding", sharding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents; each stage's rows are a table before the next reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
