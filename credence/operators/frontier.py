"""Approval/return frontier of both policies, calibrated on training and applied to test loans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.economics import raroc_metrics
from credence.operators.policies import calibrate
from credence.operators.sweep import sweep

POLICIES = ("champion", "challenger")


def frontier_measures(train: DataFrame, test: DataFrame,
                      targets: Sequence[float] = fixed.FRONTIER_QUANTILES,
                      policies: Sequence[str] = POLICIES) -> DataFrame:
    """Additive sums per policy and target; every frontier and sensitivity table starts here."""
    targets = sorted(targets)
    fico, pd = calibrate(train, targets, "champion" in policies, "challenger" in policies)
    cutoffs = {"champion": fico, "challenger": pd}
    return sweep(test, targets, {p: cutoffs[p] for p in policies})


def frontier_points(measures: DataFrame, lgd: float = fixed.LGD,
                    opex_rate: float = fixed.OPEX_RATE,
                    capital_rate: float = fixed.CAPITAL_RATE) -> DataFrame:
    """All metrics per policy and target, one row each."""
    metrics = raroc_metrics(F.col("loans"), lgd, opex_rate, capital_rate)
    return measures.select("policy", "target_quantile", "cutoff",
                           *[value.alias(name) for name, value in metrics.items()])


def frontier(points: DataFrame) -> DataFrame:
    """One row per target with both policies side by side."""
    names = {"champion": "fico_cutoff", "challenger": "pd_threshold"}
    columns = []
    for policy in POLICIES:
        for source in ("cutoff", "approval_rate", "raroc", "loss_rate"):
            name = names[policy] if source == "cutoff" else source
            columns.append(F.max(F.when(F.col("policy") == policy, F.col(source)))
                           .alias(f"{policy}_{name}"))
    return points.groupBy("target_quantile").agg(*columns)


def _first_best(points: DataFrame, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("raroc"), "target_quantile")
    return points.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")


def best_points(points: DataFrame) -> DataFrame:
    """Highest-RAROC point per policy; the first on ties."""
    return _first_best(points, "policy")


def best_point(points: DataFrame, policy: str) -> DataFrame:
    if policy not in POLICIES:
        raise ValueError("policy must be 'champion' or 'challenger'")
    return best_points(points.filter(F.col("policy") == policy))


def best_with_delta(points: DataFrame) -> DataFrame:
    """Best point per policy, each with the challenger-minus-champion RAROC difference."""
    sign = F.when(F.col("policy") == "challenger", 1).otherwise(-1)
    return best_points(points).withColumn(
        "delta_challenger_minus_champion",
        F.sum(F.col("raroc") * sign).over(Window.partitionBy()))


def best_per_setting(points: DataFrame) -> DataFrame:
    return _first_best(points, "swept_parameter", "parameter_value", "policy")
