"""The reports of a policy backtest over a clean loan table, as jobs.

    spark-submit --py-files credence.zip credence/plans/reports.py REPORT --clean PATH --out PATH

or ``python -m credence.plans.reports REPORT ...``. ``ingest`` and ``sample`` build the tables;
every other report reads the clean table, trains or loads the model if it needs one, and writes
its result tables under ``--out``.
"""

from __future__ import annotations

import argparse
import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from credence import fixed_values as fixed
from credence.operators import drift, parity, pd_model, policies, vintage
from credence.operators import frontier as front
from credence.operators import sensitivity as sens
from credence.operators.features import fitted_medians, prepare_features, time_split
from credence.operators.ranking import ranking_quality
from credence.plans import evaluation as ev
from credence.plans.ingestion import run_ingestion, write_demo_sample
from credence.sources.loan_store import read_loans
from credence.sources.staging import path_exists


FACTS = "split string, source string, medians map<string,double>"


@dataclass(frozen=True)
class Backtest:
    """Prepared loans with the model's ``pd``, and their time split."""

    loans: DataFrame
    train: DataFrame
    test: DataFrame
    model: PipelineModel


def backtest(clean: DataFrame, model_path: str | None = None,
             split: str = fixed.SPLIT_DATE) -> Backtest:
    """Prepares and splits the loans and scores them with the model of the training years.

    A model stored at ``model_path`` is loaded with the medians it was fitted on; it must be of the
    same split and table, or its own training rows could be scored as test rows. Without one a
    model is trained, and stored there if a path is given. The score is a column expression, so
    every report is a scan of its own columns.
    """
    spark = clean.sparkSession
    source = hashlib.sha256("\n".join(sorted(clean.inputFiles())).encode()).hexdigest()
    facts = f"{model_path}-facts"
    if model_path and path_exists(spark, f"{facts}/_SUCCESS"):
        stored = spark.read.schema(FACTS).json(facts).first()
        if (stored.split, stored.source) != (split, source):
            raise ValueError(f"the model at {model_path} is of split {stored.split} and may be of "
                             f"another table; wanted split {split}")
        medians, model = stored.medians, PipelineModel.load(model_path)
        prepared = prepare_features(clean, medians=medians)
    else:
        medians = fitted_medians(clean)
        prepared = prepare_features(clean, medians=medians)
        model = pd_model.train_challenger(time_split(prepared, split)[0])
        if model_path:
            model.write().overwrite().save(model_path)
            spark.createDataFrame([(split, source, medians)], FACTS).coalesce(1).write.mode(
                "overwrite").json(facts)
    scored = prepared.withColumn("pd", pd_model.pd_expression(model))
    return Backtest(scored, *time_split(scored, split), model)


def evaluation(test: Backtest) -> dict[str, DataFrame]:
    comparison = ev.policy_comparison(test.train, test.test)
    return {
        "coefficients": pd_model.coefficients(test.model, test.loans),
        "ranking_quality": ranking_quality(test.test),
        "policy_comparison": comparison,
        "policy_delta": policies.policy_delta(comparison, ev.OPTIMIZED, ev.CHAMPION),
    }


def frontier(test: Backtest) -> dict[str, DataFrame]:
    points = front.frontier_points(front.frontier_measures(test.train, test.test))
    return {"frontier": front.frontier(points), "frontier_best": front.best_with_delta(points)}


def sensitivity(test: Backtest) -> dict[str, DataFrame]:
    result = sens.sensitivity(
        front.frontier_measures(test.train, test.test, fixed.FINE_QUANTILES))
    return {"sensitivity": result, "robustness": sens.robustness(result),
            "optimum_stability": sens.optimum_stability(result)}


def parity_screen(test: Backtest) -> dict[str, DataFrame]:
    """Illustrative only: the group label rests on made-up probabilities."""
    return {"proxy_counts": parity.proxy_counts(parity.assign_proxy(test.loans)),
            "parity_screen": parity.parity_screen(
                parity.assign_proxy(test.test), ev.three_policies(test.train))}


MODEL_REPORTS: dict[str, Callable[[Backtest], dict[str, DataFrame]]] = {
    "evaluation": evaluation, "frontier": frontier, "sensitivity": sensitivity,
    "parity": parity_screen,
}


def vintages(clean: DataFrame) -> dict[str, DataFrame]:
    return {"vintage_curve": vintage.vintage_curve(clean),
            "vintage_summary": vintage.vintage_summary(clean),
            "loans_per_issue_year": vintage.loans_per_issue_year(clean)}


def monitoring(clean: DataFrame) -> dict[str, DataFrame]:
    train, test = time_split(prepare_features(clean))
    report = drift.psi_report(train, test, fixed.NUMERIC_FEATURES, fixed.CATEGORICAL_FEATURES)
    return {"psi_report": report, "psi_status_summary": drift.status_summary(report)}


TABLE_REPORTS: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {
    "vintage": vintages, "drift": monitoring,
}


def run_report(name: str, clean: DataFrame, out: str, model_path: str | None = None) -> list[str]:
    """Writes the report's tables under ``out`` and returns their names."""
    if name in TABLE_REPORTS:
        tables = TABLE_REPORTS[name](clean)
    else:
        tables = MODEL_REPORTS[name](backtest(clean, model_path))
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{table}")
    return list(tables)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("report",
                        choices=["ingest", "sample", *TABLE_REPORTS, *MODEL_REPORTS])
    parser.add_argument("--clean", required=True, help="clean loan table")
    parser.add_argument("--raw", help="raw CSV export (ingest)")
    parser.add_argument("--log", help="run log folder (ingest)")
    parser.add_argument("--out", help="folder for result tables, or the sample's path")
    parser.add_argument("--model", help="folder to load the model from, or to store it in")
    parser.add_argument("--multiline", action="store_true",
                        help="quoted cells of the export hold line breaks (ingest)")
    parser.add_argument("--rows", type=int, default=fixed.SAMPLE_ROWS, help="sample size")
    given = parser.parse_args(arguments)
    needed = ["raw", "log"] if given.report == "ingest" else ["out"]
    absent = [f"--{n}" for n in needed if getattr(given, n) is None]
    if absent:
        parser.error(f"{given.report} needs {' and '.join(absent)}")
    spark = SparkSession.builder.appName(f"credence {given.report}").getOrCreate()
    if given.report == "ingest":
        run_ingestion(spark, given.raw, given.clean, given.log, given.multiline)
    elif given.report == "sample":
        write_demo_sample(spark, given.clean, given.out, given.rows)
    else:
        run_report(given.report, read_loans(spark, given.clean), given.out, given.model)


if __name__ == "__main__":
    main()
