"""Population stability index (PSI) of features against a baseline population."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.counting import count_where
from credence.operators.quantiles import exact_quantiles

STATUSES = ["significant_shift", "moderate_shift", "stable", "insufficient_data"]


def classify(psi: Column) -> Column:
    return (F.when(psi.isNull(), "insufficient_data").when(psi < fixed.PSI_MODERATE, "stable")
            .when(psi < fixed.PSI_SIGNIFICANT, "moderate_shift").otherwise("significant_shift"))


def inner_edges(baseline: DataFrame, features: Sequence[str],
                buckets: int = fixed.PSI_BUCKETS) -> dict[str, list[float] | None]:
    """Distinct baseline quantiles without the two ends; null where fewer than three differ."""
    shares = fixed.linspace(0.0, 1.0, buckets + 1)
    quantiles = exact_quantiles(baseline, {name: shares for name in features}) if features else {}
    edges: dict[str, list[float] | None] = {}
    for name, values in quantiles.items():
        distinct = sorted({v for v in values if v is not None})
        edges[name] = distinct[1:-1] if len(distinct) >= 3 else None
    return edges


def bin_of(value: Column, edges: Sequence[float] | None) -> Column:
    """Right-closed bin as text: the number of inner edges below the value; null for no number."""
    known = value.isNotNull() & ~F.isnan(value)
    below = sum(((value > F.lit(edge)).cast("int") for edge in edges or ()), F.lit(0))
    return F.when(known, below.cast("string"))


def binned(rows: DataFrame, edges: Mapping[str, list[float] | None],
           categorical: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, type, bin) for every non-null feature value, in one pass; bins are text."""
    cells = [(name, "numeric", bin_of(F.col(name).cast("double"), cut))
             for name, cut in edges.items()]
    cells += [(name, "categorical", F.col(name).cast("string")) for name in categorical]
    return rows.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(name).alias("feature"), F.lit(kind).alias("type"), value.alias("bin"))
        for name, kind, value in cells]))).filter(F.col("bin").isNotNull())


def psi_term(expected: Column, actual: Column) -> Column:
    """(a - e) ln(a / e) of two shares floored away from zero."""
    e = F.greatest(expected, F.lit(fixed.PSI_FLOOR))
    a = F.greatest(actual, F.lit(fixed.PSI_FLOOR))
    return (a - e) * F.log(a / e)


def psi_report(baseline: DataFrame, actual: DataFrame, numeric: Sequence[str],
               categorical: Sequence[str], buckets: int = fixed.PSI_BUCKETS) -> DataFrame:
    """(feature, type, psi, status), most drifted first.

    A bin empty on both sides adds nothing, so no grid of bins is needed. Both populations are read
    once; the totals, one row per feature, are summed from the counts and broadcast, so a feature
    with many categories stays spread over tasks. A numeric feature with fewer than three distinct
    edges has one bin and so scores 0. An empty side gives a null PSI and 'insufficient_data'.
    """
    edges = inner_edges(baseline, numeric, buckets)
    columns = [*numeric, *categorical]
    is_baseline = F.col("is_baseline")
    both = baseline.select(*columns, F.lit(True).alias("is_baseline")).unionByName(
        actual.select(*columns, F.lit(False).alias("is_baseline")))
    counts = binned(both, edges, categorical, ["is_baseline"]).groupBy(
        "feature", "type", "bin").agg(count_where(is_baseline).alias("expected"),
                                      count_where(~is_baseline).alias("actual"))
    totals = counts.groupBy("feature", "type").agg(F.sum("expected").alias("expected_total"),
                                                   F.sum("actual").alias("actual_total"))
    filled = (F.col("expected_total") > 0) & (F.col("actual_total") > 0)
    term = F.when(filled, psi_term(F.col("expected") / F.col("expected_total"),
                                   F.col("actual") / F.col("actual_total")))
    scores = counts.join(F.broadcast(totals), ["feature", "type"]).groupBy(
        "feature", "type").agg(F.sum(term).alias("psi"))
    features = baseline.sparkSession.createDataFrame(
        [(name, "numeric") for name in numeric] + [(name, "categorical") for name in categorical],
        "feature string, type string")
    return features.join(scores, ["feature", "type"], "left").withColumn(
        "status", classify(F.col("psi"))).orderBy(F.desc_nulls_last("psi"), "feature")


def status_summary(report: DataFrame) -> DataFrame:
    """Features per status."""
    return report.groupBy("status").agg(
        F.count(F.lit(1)).alias("features"),
        F.array_join(F.array_sort(F.collect_list("feature")), ", ").alias("feature_list"))
