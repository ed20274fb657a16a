"""AUC, Gini and KS of a score, exact for any number of loans.

Ranking needs running counts over all scores in order. One global window would put every score in
one task, so scores are counted per distinct value, ranked inside fixed slices of the score range,
and joined to the running totals of the slices. Grid scores bound a slice to about 61,000 values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credence.fixed_values import TARGET
from credence.functions.counting import count_where

SLICES = 2**14


def ranking_quality(loans: DataFrame, score: str = "pd", label: str = TARGET) -> DataFrame:
    """One row (auc, gini, ks); all null when only one class is present."""
    # The slice is declared non-null so that the join below adds no null filter to one side only:
    # equal sides let Spark compute the counts once.
    scores = loans.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("bad"),
        count_where(F.col(label) == 0).alias("good")).withColumn(
        "slice", F.coalesce(F.greatest(F.lit(0), F.least(
            F.lit(SLICES), F.floor(F.col("score") * SLICES))).cast("int"), F.lit(0)))
    upward = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # At most SLICES + 1 rows: one task and a broadcast are both safe.
    slices = scores.groupBy("slice").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    offsets = slices.select(
        "slice",
        F.coalesce(F.sum("bad").over(upward), F.lit(0)).alias("bad_before"),
        F.coalesce(F.sum("good").over(upward), F.lit(0)).alias("good_before"),
        F.sum("bad").over(everything).alias("bad_total"),
        F.sum("good").over(everything).alias("good_total"))
    inside = Window.partitionBy("slice").orderBy("score").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = scores.withColumns({
        "bad_run": F.sum("bad").over(inside), "good_run": F.sum("good").over(inside),
    }).join(F.broadcast(offsets), "slice")
    good_below = F.col("good_before") + F.col("good_run") - F.col("good")
    wins = F.col("bad") * (good_below + F.col("good") / 2.0)
    gap = F.abs(
        F.try_divide(F.col("bad_before") + F.col("bad_run"), F.col("bad_total"))
        - F.try_divide(F.col("good_before") + F.col("good_run"), F.col("good_total")))
    return ranked.agg(
        F.try_divide(F.sum(wins), F.max("bad_total").cast("double") * F.max("good_total"))
        .alias("auc"), F.max(gap).alias("ks")).select(
        "auc", (2 * F.col("auc") - 1).alias("gini"), "ks")
