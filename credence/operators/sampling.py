"""Exact-size seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.fixed_values import SAMPLE_ROWS, SEED
from credence.functions.draws import uniform_draw
from credence.operators.quantiles import value_at_rank


def sample_rows(df: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED,
                key: str = "loan_id") -> DataFrame:
    """The ``rows`` records with the smallest draws; all records when there are no more.

    The draw at the cut is found by rank and applied as a filter, so no task sorts or holds the
    sample. ``key`` must be unique.
    """
    total = df.count()
    if total <= rows:
        return df
    if rows <= 0:
        return df.limit(0)
    drawn = df.withColumn("draw", uniform_draw(F.col(key), seed))
    cut, below = value_at_rank(drawn, "draw", rows - 1, (0.0, 1.0))
    # Equal draws at the cut are md5 collisions: a row or two.
    ties = drawn.filter(F.col("draw") == cut).orderBy(key).limit(rows - below)
    return drawn.filter(F.col("draw") < cut).unionByName(ties).drop("draw")
