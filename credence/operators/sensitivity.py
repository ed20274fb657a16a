"""How the policy comparison moves with the cost assumptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.economics import raroc_metrics
from credence.operators.frontier import best_per_setting

PARAMETERS = ["lgd", "opex_rate", "capital_rate"]
BASE = {"lgd": fixed.LGD, "opex_rate": fixed.OPEX_RATE, "capital_rate": fixed.CAPITAL_RATE}


def sensitivity(measures: DataFrame, lgd: Sequence[float] = fixed.LGD_RANGE,
                opex: Sequence[float] = fixed.OPEX_RANGE,
                capital: Sequence[float] = fixed.CAPITAL_RANGE) -> DataFrame:
    """One parameter at a time, others at base: each policy's best point on its own frontier.

    ``measures`` are the frontier's additive sums: a couple of hundred rows at most, each repeated
    per setting. No setting touches a loan again.
    """
    settings = []
    for parameter, values in zip(PARAMETERS, (lgd, opex, capital)):
        for value in values:
            used = {**BASE, parameter: float(value)}
            settings.append(F.struct(
                F.lit(PARAMETERS.index(parameter)).alias("parameter_no"),
                F.lit(parameter).alias("swept_parameter"),
                F.lit(float(value)).alias("parameter_value"),
                *[F.lit(used[p]).alias(f"used_{p}") for p in PARAMETERS]))
    spread = measures.select("*", F.inline(F.array(*settings)))
    metrics = raroc_metrics(F.col("loans"), *[F.col(f"used_{p}") for p in PARAMETERS])
    points = spread.select(
        "parameter_no", "swept_parameter", "parameter_value", "policy", "target_quantile",
        metrics["raroc"].alias("raroc"), metrics["approval_rate"].alias("approval_rate"))

    def of(policy: str, name: str):
        return F.max(F.when(F.col("policy") == policy, F.col(name))).alias(
            f"{policy}_best_{name}")

    best = best_per_setting(points).groupBy(
        "parameter_no", "swept_parameter", "parameter_value").agg(
        of("champion", "raroc"), of("champion", "approval_rate"),
        of("challenger", "raroc"), of("challenger", "approval_rate"))
    champion, challenger = F.col("champion_best_raroc"), F.col("challenger_best_raroc")
    return best.withColumns({
        "delta_challenger_minus_champion": challenger - champion,
        "champion_wins": champion >= challenger,
    }).orderBy("parameter_no", "parameter_value").drop("parameter_no")


def robustness(result: DataFrame) -> DataFrame:
    """Per parameter: does one policy win at every tested value?"""
    delta = F.col("delta_challenger_minus_champion")
    return result.groupBy("swept_parameter").agg(
        F.when(F.bool_and("champion_wins"), "champion_always_wins")
        .when(~F.bool_or("champion_wins"), "challenger_always_wins")
        .otherwise("conclusion_depends_on_assumption").alias("robustness"),
        F.min(delta).alias("min_delta"), F.max(delta).alias("max_delta"))


def optimum_stability(result: DataFrame, places: int = 4) -> DataFrame:
    """Per policy: the distinct best approval rates over all settings, and whether there is one."""
    pairs = F.array(*[
        F.struct(F.lit(p).alias("policy"),
                 F.round(F.col(f"{p}_best_approval_rate"), places).alias("rate"))
        for p in ("champion", "challenger")])
    return result.select(F.inline(pairs)).groupBy("policy").agg(
        F.array_sort(F.collect_set("rate")).alias("rates")).select(
        "policy", F.size("rates").cast("long").alias("distinct_rates"),
        F.array_join(F.transform("rates", lambda r: r.cast("string")), ", ").alias("rates"),
        (F.size("rates") == 1).alias("stable"))
