"""Reports that put several operators together. Each takes loans that carry a ``pd``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.economics import raroc_metrics
from credence.operators.frontier import best_points, frontier_measures, frontier_points
from credence.operators.policies import (
    calibrate,
    challenger_approves,
    champion_approves,
    compare_policies,
)
from credence.operators.ranking import ranking_quality
from credence.operators.sweep import sweep

CHAMPION = "champion"
VOLUME_MATCHED = "challenger_volume_matched"
OPTIMIZED = "challenger_raroc_optimized"


def pd_threshold_sweep(train: DataFrame, targets: Sequence[float] = fixed.SWEEP_QUANTILES,
                       lgd: float = fixed.LGD, opex_rate: float = fixed.OPEX_RATE,
                       capital_rate: float = fixed.CAPITAL_RATE) -> DataFrame:
    """Every metric at each PD threshold, calibrated and measured on the training loans."""
    targets = sorted(targets)
    _, thresholds = calibrate(train, targets, fico=False)
    return _sweep_metrics(train, targets, thresholds, lgd, opex_rate, capital_rate)


def _sweep_metrics(train, targets, thresholds, lgd=fixed.LGD, opex_rate=fixed.OPEX_RATE,
                   capital_rate=fixed.CAPITAL_RATE) -> DataFrame:
    points = sweep(train, targets, {"challenger": thresholds})
    metrics = raroc_metrics(F.col("loans"), lgd, opex_rate, capital_rate)
    return points.select("target_quantile", F.col("cutoff").alias("pd_threshold"),
                         *[value.alias(name) for name, value in metrics.items()])


def raroc_optimal(result: DataFrame) -> DataFrame:
    """The sweep's highest-RAROC row, the first on ties. The sweep is a few rows long."""
    return result.orderBy(F.desc_nulls_last("raroc"), "target_quantile").limit(1)


def raroc_optimal_threshold(train: DataFrame,
                            targets: Sequence[float] = fixed.SWEEP_QUANTILES) -> float:
    return raroc_optimal(pd_threshold_sweep(train, targets)).first()["pd_threshold"]


def three_policies(train: DataFrame, target: float = fixed.TARGET_APPROVAL_RATE,
                   targets: Sequence[float] = fixed.SWEEP_QUANTILES) -> dict[str, Column]:
    """Champion and challenger at the target volume, and the RAROC-optimal challenger.

    Both scores and the whole sweep grid are calibrated together, in one set of scans.
    """
    targets = sorted(targets)
    fico, thresholds = calibrate(train, [target, *targets])
    best = raroc_optimal(_sweep_metrics(train, targets, thresholds[1:])).first()
    return {
        CHAMPION: champion_approves(fico[0]),
        VOLUME_MATCHED: challenger_approves(thresholds[0]),
        OPTIMIZED: challenger_approves(best["pd_threshold"]),
    }


def policy_comparison(train: DataFrame, test: DataFrame) -> DataFrame:
    return compare_policies(test, three_policies(train))


def what_if(train: DataFrame, test: DataFrame, target: float) -> DataFrame:
    """Both cutoffs at one target rate and what they earn on the test loans."""
    fico, thresholds = calibrate(train, [target])
    result = compare_policies(test, {CHAMPION: champion_approves(fico[0]),
                                     "challenger": challenger_approves(thresholds[0])})
    cutoff = F.when(F.col("policy") == CHAMPION, F.lit(fico[0])).otherwise(F.lit(thresholds[0]))
    return result.withColumn("cutoff", cutoff).withColumn("target_rate", F.lit(target))


def overview(loans: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """(item, value): loans, each policy's best point, ranking quality."""
    best = best_points(frontier_points(frontier_measures(train, test)))
    items = [("raroc", "best_raroc"), ("approval_rate", "best_approval_rate"),
             ("cutoff", "best_cutoff")]
    policy_rows = best.select(F.inline(F.array(*[
        F.struct(F.concat_ws("_", "policy", F.lit(name)).alias("item"),
                 F.col(column).alias("value")) for column, name in items])))
    quality = ranking_quality(test).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("item"), F.col(name).alias("value"))
        for name in ("auc", "gini", "ks")])))
    size = loans.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("loans").alias("item"), "value")
    return size.unionByName(policy_rows).unionByName(quality)
