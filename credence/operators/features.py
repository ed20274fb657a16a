"""Time split and model-input preparation."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions import parsing
from credence.operators.quantiles import exact_quantiles

IMPUTED = ["emp_length_years", "revol_util_frac"]


def with_issue_date(df: DataFrame) -> DataFrame:
    """Adds ``issue_date`` from the month text unless the column is there."""
    if "issue_date" in df.columns:
        return df
    return df.withColumn("issue_date", parsing.month_date(F.col("issue_d")))


def time_split(df: DataFrame, cutoff: str = fixed.SPLIT_DATE) -> tuple[DataFrame, DataFrame]:
    """(rows issued before the cutoff, rows issued on or after it); undated rows are in neither.

    On a table partitioned by ``issue_year`` the extra year bound prunes partitions.
    """
    df = with_issue_date(df)
    date = datetime.date.fromisoformat(cutoff)
    before, after = F.col("issue_date") < F.lit(date), F.col("issue_date") >= F.lit(date)
    if "issue_year" in df.columns:
        last_year = date.year - 1 if (date.month, date.day) == (1, 1) else date.year
        before = before & (F.col("issue_year") <= last_year)
        after = after & (F.col("issue_year") >= date.year)
    return df.filter(before), df.filter(after)


def impute_medians(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value))
                           for name, value in medians.items() if value is not None})


def fill_unknown(df: DataFrame) -> DataFrame:
    return df.fillna(fixed.UNKNOWN_CATEGORY, subset=fixed.CATEGORICAL_FEATURES)


def fitted_medians(df: DataFrame) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in IMPUTED}).items()}


def prepare_features(df: DataFrame, fit_on: DataFrame | None = None,
                     medians: Mapping[str, float | None] | None = None) -> DataFrame:
    """Median-filled numbers, 'UNKNOWN' for missing categories.

    Medians come from the whole table, test rows included, as the published results do; pass the
    training rows as ``fit_on`` to keep test rows out of them, or ``medians`` fitted before.
    """
    missing = [c for c in fixed.NUMERIC_FEATURES + fixed.CATEGORICAL_FEATURES
               if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    if medians is None:
        medians = fitted_medians(df if fit_on is None else fit_on)
    return fill_unknown(impute_medians(df, medians))
