"""Default emergence by origination year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credence.fixed_values import CURVE_MONTHS, TARGET
from credence.functions import parsing


def with_issue_year(df: DataFrame) -> DataFrame:
    """Adds ``issue_year`` from the month text unless the column is there."""
    if "issue_year" in df.columns:
        return df
    return df.withColumn("issue_year", parsing.year_of(parsing.month_number(F.col("issue_d"))))


def _counts(df: DataFrame) -> DataFrame:
    """Loans per (year, label, month): a few hundred rows a year, combined before the shuffle."""
    return with_issue_year(df).filter(F.col("issue_year").isNotNull()).groupBy(
        "issue_year", TARGET, "months_on_book").agg(F.count(F.lit(1)).alias("loans"))


def vintage_curve(df: DataFrame, max_months: int = CURVE_MONTHS) -> DataFrame:
    """Cumulative default rate per year and month 0..max_months over the whole year's loans.

    Later or undated defaults stay in the denominator and never reach the numerator.
    """
    month = F.when(F.col("months_on_book").isNotNull(),
                   F.greatest(F.ceil("months_on_book").cast("int"), F.lit(0)))
    whole_year = Window.partitionBy("issue_year")
    counts = _counts(df).select(
        "issue_year",
        F.when((F.col(TARGET) == 1) & (month <= max_months), month).alias("month"), "loans")
    sized = counts.groupBy("issue_year", "month").agg(F.sum("loans").alias("defaults")).select(
        "*", F.sum("defaults").over(whole_year).alias("vintage_size"))
    # One zero per month of the year keeps months without defaults in the curve.
    months = F.sequence(F.lit(0), F.lit(max_months))
    per_year = sized.groupBy("issue_year", "vintage_size").agg(
        F.map_from_entries(F.collect_list(F.when(
            F.col("month").isNotNull(), F.struct("month", "defaults")))).alias("by_month"))
    dense = per_year.select("issue_year", "vintage_size", "by_month",
                            F.explode(months).alias("month"))
    running = whole_year.orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cumulative = F.sum(F.coalesce(F.try_element_at("by_month", "month"), F.lit(0))).over(running)
    return dense.select(
        "issue_year", "month", (cumulative / F.col("vintage_size")).alias(
            "cumulative_default_rate"),
        cumulative.alias("cumulative_defaults"), "vintage_size")


def vintage_summary(df: DataFrame) -> DataFrame:
    """Per year: loans, final default rate, median months to default (null without defaults)."""
    bad = F.col(TARGET) == 1
    return _counts(df).groupBy("issue_year").agg(
        F.sum("loans").alias("vintage_size"),
        (F.sum(F.when(bad, F.col("loans")).otherwise(0)) / F.sum("loans"))
        .alias("ultimate_default_rate"),
        F.percentile(F.when(bad, F.col("months_on_book").cast("double")), 0.5, F.col("loans"))
        .alias("median_months_to_default"))


def loans_per_issue_year(df: DataFrame) -> DataFrame:
    return with_issue_year(df).filter(F.col("issue_year").isNotNull()).groupBy(
        "issue_year").agg(F.count(F.lit(1)).alias("loans")).orderBy("issue_year")
