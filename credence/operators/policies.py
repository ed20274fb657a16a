"""Approval policies: calibrated cutoffs, decisions and realised economics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.economics import MEASURES, loan_measures, raroc_metrics
from credence.operators.quantiles import exact_quantiles

SCORE_BOUNDS = {"pd": (0.0, 1.0)}


def champion_approves(cutoff: float = fixed.CHAMPION_FICO_CUTOFF) -> Column:
    """Rule policy: approve from the FICO cutoff up."""
    return F.coalesce(F.col("fico_avg") >= F.lit(float(cutoff)), F.lit(False))


def challenger_approves(threshold: float) -> Column:
    """Model policy: approve up to the probability-of-default threshold."""
    return F.coalesce(F.col("pd") <= F.lit(float(threshold)), F.lit(False))


def calibrate(train: DataFrame, targets: Sequence[float], fico: bool = True,
              pd: bool = True) -> tuple[list[float] | None, list[float] | None]:
    """FICO cutoffs and PD thresholds that approve each target share of the training loans."""
    wanted: dict[str, list[float]] = {}
    if fico:
        wanted["fico_avg"] = [1 - t for t in targets]
    if pd:
        wanted["pd"] = list(targets)
    found = exact_quantiles(train, wanted, {k: v for k, v in SCORE_BOUNDS.items() if k in wanted})
    return found.get("fico_avg"), found.get("pd")


def calibrate_fico_cutoff(train: DataFrame,
                          target: float = fixed.TARGET_APPROVAL_RATE) -> float:
    return calibrate(train, [target], pd=False)[0][0]


def calibrate_pd_threshold(train: DataFrame,
                           target: float = fixed.TARGET_APPROVAL_RATE) -> float:
    return calibrate(train, [target], fico=False)[1][0]


def compare_policies(loans: DataFrame, policies: Mapping[str, Column], lgd: float = fixed.LGD,
                     opex_rate: float = fixed.OPEX_RATE,
                     capital_rate: float = fixed.CAPITAL_RATE) -> DataFrame:
    """One metrics row per policy from a single pass: conditional sums, no row is repeated."""
    measures, names = loan_measures(), list(policies)
    sums = [F.count(F.lit(1)).alias("loans")]
    for i, approved in enumerate(policies.values()):
        sums += [F.coalesce(F.sum(F.when(approved, value)), F.lit(0).cast(
            "long" if name == "n" else "double")).alias(f"{name}_{i}")
                 for name, value in measures.items()]
    by_policy = [F.struct(F.lit(policy).alias("policy"),
                          *[F.col(f"{m}_{i}").alias(m) for m in MEASURES], F.col("loans"))
                 for i, policy in enumerate(names)]
    rows = loans.agg(*sums).select(F.inline(F.array(*by_policy)))
    metrics = raroc_metrics(F.col("loans"), lgd, opex_rate, capital_rate)
    return rows.select("policy", *[value.alias(name) for name, value in metrics.items()])


def policy_delta(comparison: DataFrame, policy: str, against: str) -> DataFrame:
    """``policy`` minus ``against`` for volume, approval, loss and return."""
    fields = ["n", "approval_rate", "loss_rate", "raroc"]
    sign = F.when(F.col("policy") == policy, 1).when(F.col("policy") == against, -1).otherwise(0)
    return comparison.agg(*[F.sum(F.col(f) * sign).alias(f"{f}_delta") for f in fields])


def swap_set(loans: DataFrame, champion: Column, challenger: Column,
             lgd: float = fixed.LGD) -> DataFrame:
    """2x2 of who approves whom: volume, loss and mix of the loans the two policies trade."""
    return loans.groupBy(champion.alias("champion_approved"),
                         challenger.alias("challenger_approved")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(fixed.TARGET).alias("default_rate"),
        (lgd * F.sum(F.col("loan_amnt") * F.col(fixed.TARGET))
         / F.sum("loan_amnt")).alias("loss_rate"),
        F.avg("int_rate_frac").alias("mean_rate"),
        F.avg("loan_amnt").alias("mean_amount"),
        F.avg("term_months").alias("mean_term"))
