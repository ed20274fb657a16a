"""Loan tables the reports read, derived from the given tables and staged once per application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credence.functions.scoring import scorecard
from credence.operators.cleaning import clean_loans
from credence.operators.features import prepare_features, time_split
from credence.plans.reports import Backtest, backtest
from credence.session import settings
from credence.sources.csv_loans import load_raw
from credence.sources.loan_tape import raw_loans
from credence.sources.staging import (
    StagedTables,
    input_fingerprint,
    input_size,
    path_exists,
    stage_path,
    staged,
    staging_settings,
    write_parts,
)

#: Bytes of input whose join is shuffled at a time for the CSV export, and the most such shares: each
#: reads the input again.
SHARE_BYTES, MOST_SHARES = 256 << 20, 4


def _inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{t}.parquet" for t in ("lineitem", "orders", "customer")]


def mark(spark: SparkSession, sf_dir: str) -> str:
    return input_fingerprint(spark, *_inputs(sf_dir))


def space(spark: SparkSession, sf_dir: str, prefix: str) -> StagedTables:
    """Room for the tables of one query or table of the given inputs."""
    return StagedTables(spark, prefix, mark(spark, sf_dir), input_size(spark, *_inputs(sf_dir)))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw export, text columns as text."""
    return staged(spark, "raw_loans", mark(spark, sf_dir), lambda: raw_loans(spark, sf_dir),
                  input_bytes=input_size(spark, *_inputs(sf_dir)))


def raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw export through packed CSV files and back.

    The files are a quarter of their text. They are written from the staged table where there is one,
    else straight from the joins, a share of the orders at a time: neither a second copy of the rows
    nor the shuffle of all of them is on disk beside the files.
    """
    path, table = (stage_path(spark, name, mark(spark, sf_dir)) for name in ("raw_csv", "raw_loans"))
    if not path_exists(spark, f"{path}/_SUCCESS"):
        size = input_size(spark, *_inputs(sf_dir))
        if path_exists(spark, f"{table}/_SUCCESS"):
            shares, parts = 1, iter([raw(spark, sf_dir)])
        else:
            shares = max(1, min(MOST_SHARES, -(-size // SHARE_BYTES)))
            parts = (raw_loans(spark, sf_dir, share, shares) for share in range(shares))
        with settings(spark, staging_settings(spark, size // shares)):
            write_parts(spark, parts, path, lambda part: part.write.options(
                header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                compression="gzip"), "csv")
    return load_raw(spark, path)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean loan table, partitioned by issue year."""
    return staged(spark, "clean_loans", mark(spark, sf_dir),
                  lambda: clean_loans(raw(spark, sf_dir), space(spark, sf_dir, "clean")),
                  ("issue_year",), input_size(spark, *_inputs(sf_dir)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean loans with the scorecard's ``pd``; a projection, so nothing more is stored."""
    return clean(spark, sf_dir).withColumn("pd", scorecard())


def scored_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return time_split(scored(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_features(clean(spark, sf_dir))


def model_backtest(spark: SparkSession, sf_dir: str) -> Backtest:
    """Loans scored by the PD model of the training years, fitted once per application."""
    return backtest(clean(spark, sf_dir), stage_path(spark, "pd_model", mark(spark, sf_dir)))
