"""Four-fifths parity screen over an illustrative group label.

The state probabilities behind the label are made up. Output shows how the screen works and says
nothing about any real population.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.counting import count_where
from credence.functions.draws import uniform_draw

GROUP = "protected_class_proxy"
GROUPS = ("Group A", "Group B")


def with_proxy_probability(df: DataFrame) -> DataFrame:
    """Illustrative probability of the borrower's state; a default for unlisted states."""
    table = F.create_map(*[F.lit(x) for pair in fixed.STATE_PROBABILITY.items() for x in pair])
    return df.withColumn("geo_proxy_probability", F.coalesce(
        F.try_element_at(table, F.col("addr_state")), F.lit(fixed.DEFAULT_STATE_PROBABILITY)))


def assign_proxy(df: DataFrame, seed: int = fixed.SEED, key: str = "loan_id") -> DataFrame:
    """Bernoulli group per record, drawn from its key so row order does not matter."""
    group_b = uniform_draw(F.col(key), seed) < F.col("geo_proxy_probability")
    return with_proxy_probability(df).withColumn(
        GROUP, F.when(group_b, GROUPS[1]).otherwise(GROUPS[0]))


def proxy_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(GROUP).agg(F.count(F.lit(1)).alias("loans"))


def four_fifths_ratio(rate_a: Column, rate_b: Column) -> Column:
    """Lower rate over higher rate; 1 when both are zero."""
    return F.when((rate_a == 0) & (rate_b == 0), 1.0).otherwise(
        F.least(rate_a, rate_b) / F.greatest(rate_a, rate_b))


def parity_screen(loans: DataFrame, policies: Mapping[str, Column]) -> DataFrame:
    """Approval rate per group, ratio and flag for every policy, from one pass."""
    sizes = [count_where(F.col(GROUP) == g).alias(f"n_{i}") for i, g in enumerate(GROUPS)]
    approvals = [count_where((F.col(GROUP) == g) & approved).alias(f"approved_{p}_{i}")
                 for p, approved in enumerate(policies.values()) for i, g in enumerate(GROUPS)]
    counts = loans.agg(*sizes, *approvals)

    def rate(policy: int, group: int) -> Column:
        return F.when(F.col(f"n_{group}") > 0,
                      F.col(f"approved_{policy}_{group}") / F.col(f"n_{group}")).otherwise(0.0)

    rows = [F.struct(F.lit(name).alias("policy"), rate(p, 0).alias("group_a_approval_rate"),
                     rate(p, 1).alias("group_b_approval_rate"), F.col("n_0").alias("group_a_n"),
                     F.col("n_1").alias("group_b_n")) for p, name in enumerate(policies)]
    ratio = four_fifths_ratio(F.col("group_a_approval_rate"), F.col("group_b_approval_rate"))
    return counts.select(F.inline(F.array(*rows))).withColumn(
        "four_fifths_ratio", ratio).withColumn(
        "flagged", F.col("four_fifths_ratio") < fixed.FOUR_FIFTHS)
