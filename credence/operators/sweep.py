"""Both policies at every point of a target-approval grid, from one pass over the loans.

Approved sets nest along the grid, so a loan needs only the index of the first point that approves
it. Loans are summed per pair of indexes, and running sums over that small table give every point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credence.functions.economics import MEASURES, loan_measures

# Which score decides, and whether approval means at least or at most the cutoff.
POLICY_SCORES = {"champion": ("fico_avg", "at_least"), "challenger": ("pd", "at_most")}


def first_approving_point(policy: str, cutoffs: Sequence[float]) -> Column:
    """Index of the tightest grid point that approves the row; ``len(cutoffs)`` for none."""
    name, side = POLICY_SCORES[policy]
    score = F.col(name)
    steps = F.array(*[F.lit(float(c)) for c in cutoffs])
    misses = (lambda c: c > score) if side == "at_least" else (lambda c: c < score)
    return F.when(score.isNull(), F.lit(len(cutoffs))).otherwise(
        F.size(F.filter(steps, misses)))


def nested(policy: str, cutoffs: Sequence[float]) -> list[float]:
    """Cutoffs made monotone, so rounding cannot break the nesting of approved sets."""
    pick = min if POLICY_SCORES[policy][1] == "at_least" else max
    result: list[float] = []
    for cutoff in cutoffs:
        result.append(cutoff if not result else pick(result[-1], cutoff))
    return result


def sweep(loans: DataFrame, targets: Sequence[float],
          cutoffs: Mapping[str, Sequence[float]]) -> DataFrame:
    """(policy, target_quantile, cutoff, loans, MEASURES) for every policy and grid point.

    ``targets`` must ascend, with ``cutoffs[policy][i]`` calibrated for ``targets[i]``.
    """
    policies = list(cutoffs)
    steps = {p: nested(p, cutoffs[p]) for p in policies}
    cells = loans.groupBy(*[first_approving_point(p, steps[p]).alias(f"point_{p}")
                            for p in policies]).agg(
        *[F.sum(value).alias(name) for name, value in loan_measures().items()])
    long = cells.select(
        F.inline(F.array(*[F.struct(F.lit(p).alias("policy"), F.col(f"point_{p}").alias("point"))
                           for p in policies])), *MEASURES)
    # The grid itself, with empty sums: points that gain no loan still get a row.
    grid = loans.sparkSession.createDataFrame(pa.Table.from_pylist(
        [{"policy": p, "point": i, "target_quantile": float(t), "cutoff": float(steps[p][i])}
         for p in policies for i, t in enumerate(targets)],
        schema=pa.schema([("policy", pa.string()), ("point", pa.int32()),
                          ("target_quantile", pa.float64()), ("cutoff", pa.float64())])))
    summed = grid.unionByName(long, allowMissingColumns=True).groupBy("policy", "point").agg(
        F.max("target_quantile").alias("target_quantile"), F.max("cutoff").alias("cutoff"),
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES])
    whole = Window.partitionBy("policy")
    running = whole.orderBy("point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return summed.select(
        "policy", "point", "target_quantile", "cutoff", F.sum("n").over(whole).alias("loans"),
        *[F.sum(m).over(running).alias(m) for m in MEASURES]).filter(
        F.col("target_quantile").isNotNull()).drop("point")
