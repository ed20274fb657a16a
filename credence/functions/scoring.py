"""Probability-of-default scores as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores live on a grid of 10^-9. Equal scores then compare equal whatever computed them, and a
# slice of the score range holds a known number of distinct scores.
SCORE_STEPS = 10**9


def on_grid(score: Column) -> Column:
    """Nearest grid score, as a double in [0, 1]."""
    return F.floor(score * float(SCORE_STEPS) + 0.5) / float(SCORE_STEPS)


def logistic(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


# A hand-set scorecard: intercept, (column, centre, weight) and (column, value, weight).
SCORECARD_INTERCEPT = -0.80
SCORECARD_NUMERIC = [
    ("fico_avg", 752.0, -0.004), ("dti", 16.0, 0.012), ("inq_last_6mths", 0.0, 0.05),
    ("mort_acc", 0.0, -0.03),
]
SCORECARD_MATCH = [
    ("term_months", 60.0, 0.15), ("home_ownership", "RENT", 0.10), ("purpose", "car", -0.05),
]


def scorecard(intercept: float = SCORECARD_INTERCEPT, numeric=SCORECARD_NUMERIC,
              match=SCORECARD_MATCH) -> Column:
    """Score of the scorecard for the current row, on the grid."""
    z = F.lit(intercept)
    for name, centre, weight in numeric:
        z = z + F.lit(weight) * (F.col(name) - F.lit(centre))
    for name, value, weight in match:
        z = z + F.when(F.col(name) == F.lit(value), F.lit(weight)).otherwise(0.0)
    return on_grid(logistic(z))


def fitted_score(intercept: float, numeric: Mapping[str, tuple[float, float, float]],
                 match: Mapping[tuple[str, str], float]) -> Column:
    """A fitted logistic model as one expression.

    ``numeric`` maps a column to (mean, standard deviation, weight of the z-score) and ``match``
    maps (column, category) to a weight.
    """
    return scorecard(
        intercept,
        [(name, mean, weight / deviation if deviation else 0.0)
         for name, (mean, deviation, weight) in numeric.items()],
        [(name, value, weight) for (name, value), weight in match.items()])
