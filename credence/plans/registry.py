"""Named queries over the given tables: one per operator, results rounded for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.economics import lifetime_interest
from credence.operators import cleaning, drift, features, parity, pd_model, policies, vintage
from credence.operators import frontier as front
from credence.operators import ranking
from credence.operators import sensitivity as sens
from credence.operators.sampling import sample_rows
from credence.plans import evaluation as ev
from credence.plans import loans as data
from credence.plans.ingestion import run_ingestion
from credence.sources.loan_store import load_loans, write_loans
from credence.sources.run_log import read_log
from credence.sources.staging import input_fingerprint, path_exists, stage_path, staged
from credence.streaming import drift_stream as live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE = 5_000
WHAT_IF_TARGET = 0.70
DRIFT_START = "2024-01-08"
MONEY = {"revenue", "actual_loss", "opex", "capital", "net_income", "interest", "lent"}
EXACT = {"cutoff", "champion_fico_cutoff", "challenger_pd_threshold", "pd_threshold",
         "parameter_value", "target_quantile", "pd"}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def published(df: DataFrame) -> DataFrame:
    """Doubles rounded: money to cents, cutoffs to 9 places, the rest to 6."""
    def column(name: str, kind: str):
        if kind != "double":
            return F.col(name)
        places = 2 if name in MONEY else 9 if name in EXACT else 6
        return F.round(F.col(name), places).alias(name)

    return df.select(*[column(name, kind) for name, kind in df.dtypes])


# Sources and sampling

@query
def scan_raw_loans(spark, sf_dir):
    return data.raw_csv(spark, sf_dir).select(
        "loan_id", "grade", "term", "int_rate", "emp_length", "home_ownership", "purpose",
        "revol_util", "last_pymnt_d", F.col("annual_inc").cast("double").alias("annual_inc"),
        F.col("dti").cast("double").alias("dti"))


@query
def ingest_funnel(spark, sf_dir):
    return cleaning.funnel(data.raw(spark, sf_dir)).withColumn(
        "step_no", F.col("step_no").cast("long"))


@query
def ingest_log(spark, sf_dir):
    """What the ingestion job logs of a run over the CSV export, step by step."""
    data.raw_csv(spark, sf_dir)
    mark, run = data.mark(spark, sf_dir), uuid.uuid4().hex
    source, clean, log = (stage_path(spark, name, mark)
                          for name in ("raw_csv", f"ingested_{run}", f"ingest_log_{run}"))
    run_ingestion(spark, source, clean, log)
    names = F.array(*[F.lit(name) for name, _ in cleaning.FUNNEL], F.lit("dedupe"))
    steps = read_log(spark, log).withColumn("step_no", F.array_position(names, F.col("step")))
    return steps.filter("step_no > 0").select("step_no", "step", "rows_in", "rows_out")


@query
def demo_sample(spark, sf_dir):
    return sample_rows(data.clean(spark, sf_dir), SAMPLE).select(
        "loan_id", "grade", "issue_d", "fico_avg", "defaulted")


@query
def loans_per_issue_year(spark, sf_dir):
    return vintage.loans_per_issue_year(data.clean(spark, sf_dir))


# Cleaning

def _raw_filtered(condition):
    return lambda spark, sf_dir: data.raw(spark, sf_dir).filter(condition()).select(
        "loan_id", "grade", "loan_status", "issue_d", "last_pymnt_d")


QUERIES["filter_grade"] = _raw_filtered(cleaning.in_scope_grade)
QUERIES["filter_matured"] = _raw_filtered(cleaning.has_known_outcome)
QUERIES["filter_issue_year"] = _raw_filtered(cleaning.from_mature_years)
QUERIES["filter_valid_mob"] = _raw_filtered(cleaning.has_valid_months)
QUERIES["drop_incomplete"] = _raw_filtered(cleaning.is_complete)


@query
def dedupe_loans(spark, sf_dir):
    return cleaning.deduped(
        data.raw(spark, sf_dir), data.space(spark, sf_dir, "dedupe_loans")).select(
        "loan_id", "loan_amnt", "annual_inc", "purpose", "addr_state")


@query
def clean_loans(spark, sf_dir):
    loans = cleaning.clean_loans(
        data.raw(spark, sf_dir), data.space(spark, sf_dir, "clean"))
    whole = ["months_on_book", "defaulted", "issue_year"]
    return loans.drop("issue_date").withColumns({c: F.col(c).cast("long") for c in whole})


@query
def stored_loans(spark, sf_dir):
    """The clean table through its parquet sink and back, as the full table."""
    loans, mark = data.clean(spark, sf_dir), data.mark(spark, sf_dir)
    path, sample = (stage_path(spark, name, mark) for name in ("stored_loans", "no_sample"))
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_loans(loans, path)
    return load_loans(spark, path, sample).select(
        "loan_id", F.col("issue_year").cast("long").alias("issue_year"), "fico_avg", "is_sample")


# Features

@query
def time_split_counts(spark, sf_dir):
    train, test = features.time_split(data.clean(spark, sf_dir))
    sides = train.select(F.lit("train").alias("side"), "issue_date", "defaulted").unionByName(
        test.select(F.lit("test").alias("side"), "issue_date", "defaulted"))
    return published(sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("loans"), F.avg("defaulted").alias("default_rate"),
        F.date_format(F.min("issue_date"), "yyyy-MM-dd").alias("first_issue"),
        F.date_format(F.max("issue_date"), "yyyy-MM-dd").alias("last_issue")))


@query
def impute_median(spark, sf_dir):
    return data.prepared(spark, sf_dir).select("loan_id", *features.IMPUTED)


@query
def fill_unknown(spark, sf_dir):
    return features.fill_unknown(data.clean(spark, sf_dir)).select(
        "loan_id", *fixed.CATEGORICAL_FEATURES)


# Policies and the model

def _decisions(loans, approved, *columns):
    return loans.select("loan_id", *columns, approved.alias("approved"))


@query
def champion_fixed_cutoff(spark, sf_dir):
    _, test = features.time_split(data.clean(spark, sf_dir))
    return _decisions(test, policies.champion_approves(), "fico_avg")


def _one_row(spark, **values):
    return published(spark.createDataFrame([tuple(values.values())], list(values)))


@query
def champion_cutoff(spark, sf_dir):
    train, _ = features.time_split(data.clean(spark, sf_dir))
    return _one_row(spark, target_rate=fixed.TARGET_APPROVAL_RATE,
                    cutoff=policies.calibrate_fico_cutoff(train))


@query
def champion_volume_matched(spark, sf_dir):
    train, test = features.time_split(data.clean(spark, sf_dir))
    cutoff = policies.calibrate_fico_cutoff(train)
    return _decisions(test, policies.champion_approves(cutoff), "fico_avg")


@query
def score_scorecard(spark, sf_dir):
    return data.scored(spark, sf_dir).select("loan_id", "pd")


@query
def challenger_fixed_threshold(spark, sf_dir):
    _, test = data.scored_split(spark, sf_dir)
    return _decisions(test, policies.challenger_approves(0.35), "pd")


@query
def challenger_threshold(spark, sf_dir):
    train, _ = data.scored_split(spark, sf_dir)
    return _one_row(spark, target_rate=fixed.TARGET_APPROVAL_RATE,
                    cutoff=policies.calibrate_pd_threshold(train))


@query
def challenger_volume_matched(spark, sf_dir):
    train, test = data.scored_split(spark, sf_dir)
    threshold = policies.calibrate_pd_threshold(train)
    return _decisions(test, policies.challenger_approves(threshold), "pd")


@query
def pd_threshold_sweep(spark, sf_dir):
    train, _ = data.scored_split(spark, sf_dir)
    return published(ev.pd_threshold_sweep(train))


@query
def raroc_optimal_threshold(spark, sf_dir):
    train, _ = data.scored_split(spark, sf_dir)
    return published(ev.raroc_optimal(ev.pd_threshold_sweep(train)).select(
        "target_quantile", "pd_threshold", "raroc"))


@query
def challenger_raroc_optimized(spark, sf_dir):
    train, test = data.scored_split(spark, sf_dir)
    threshold = ev.raroc_optimal_threshold(train)
    return _decisions(test, policies.challenger_approves(threshold), "pd")


@query
def ranking_quality(spark, sf_dir):
    _, test = data.scored_split(spark, sf_dir)
    return published(ranking.ranking_quality(test))


@query
def challenger_coefficients(spark, sf_dir):
    test = data.model_backtest(spark, sf_dir)
    return pd_model.coefficients(test.model, test.loans)


@query
def model_optimality(spark, sf_dir):
    """Per weight: defaults as scores and penalty explain them; those of the data at the optimum."""
    test = data.model_backtest(spark, sf_dir)
    return pd_model.explained_defaults(test.model, test.train).withColumn(
        "explained", F.round("explained", 4))


@query
def model_calibration(spark, sf_dir):
    """Expected and observed defaults of the training loans; a free intercept makes them equal."""
    train = data.model_backtest(spark, sf_dir).train
    return train.agg(F.count(F.lit(1)).alias("loans"), F.round(F.sum("pd")).alias("expected"),
                     F.sum("defaulted").alias("observed"))


@query
def score_model(spark, sf_dir):
    test = data.model_backtest(spark, sf_dir)
    return pd_model.predict_pd(test.model, test.test.drop("pd")).select("loan_id", "pd")


@query
def ranking_quality_model(spark, sf_dir):
    return published(ranking.ranking_quality(data.model_backtest(spark, sf_dir).test))


@query
def policy_comparison_model(spark, sf_dir):
    test = data.model_backtest(spark, sf_dir)
    return published(ev.policy_comparison(test.train, test.test))


@query
def frontier_model(spark, sf_dir):
    test = data.model_backtest(spark, sf_dir)
    measures = front.frontier_measures(test.train, test.test)
    return published(front.frontier(front.frontier_points(measures)))


# Economics

@query
def interest_by_term_grade(spark, sf_dir):
    interest = lifetime_interest(F.col("loan_amnt"), F.col("int_rate_frac"), F.col("term_months"))
    return published(data.clean(spark, sf_dir).groupBy("term_months", "grade").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("loan_amnt").alias("lent"),
        F.sum(interest).alias("interest")))


@query
def raroc_champion(spark, sf_dir):
    train, test = features.time_split(data.clean(spark, sf_dir))
    cutoff = policies.calibrate_fico_cutoff(train)
    return published(policies.compare_policies(
        test, {ev.CHAMPION: policies.champion_approves(cutoff)}))


@query
def raroc_challenger(spark, sf_dir):
    train, test = data.scored_split(spark, sf_dir)
    threshold = policies.calibrate_pd_threshold(train)
    return published(policies.compare_policies(
        test, {"challenger": policies.challenger_approves(threshold)}))


@query
def policy_comparison(spark, sf_dir):
    return published(ev.policy_comparison(*data.scored_split(spark, sf_dir)))


@query
def policy_delta(spark, sf_dir):
    comparison = ev.policy_comparison(*data.scored_split(spark, sf_dir))
    return published(policies.policy_delta(comparison, ev.OPTIMIZED, ev.CHAMPION))


@query
def what_if_target_rate(spark, sf_dir):
    return published(ev.what_if(*data.scored_split(spark, sf_dir), WHAT_IF_TARGET))


@query
def swap_set(spark, sf_dir):
    train, test = data.scored_split(spark, sf_dir)
    fico, thresholds = policies.calibrate(train, [fixed.TARGET_APPROVAL_RATE])
    return published(policies.swap_set(test, policies.champion_approves(fico[0]),
                                       policies.challenger_approves(thresholds[0])))


# Vintage

def _years_as_long(df):
    return df.withColumn("issue_year", F.col("issue_year").cast("long"))


QUERIES["loans_per_issue_year"] = lambda spark, sf_dir: _years_as_long(
    loans_per_issue_year(spark, sf_dir))


@query
def vintage_curve(spark, sf_dir):
    return published(_years_as_long(vintage.vintage_curve(data.clean(spark, sf_dir))).withColumn(
        "month", F.col("month").cast("long")))


@query
def vintage_summary(spark, sf_dir):
    return published(_years_as_long(vintage.vintage_summary(data.clean(spark, sf_dir))))


# Frontier and sensitivity

def _points(spark, sf_dir, names=front.POLICIES):
    return front.frontier_points(front.frontier_measures(
        *data.scored_split(spark, sf_dir), policies=names))


@query
def frontier_champion(spark, sf_dir):
    return published(_points(spark, sf_dir, ["champion"]))


@query
def frontier_challenger(spark, sf_dir):
    return published(_points(spark, sf_dir, ["challenger"]))


@query
def frontier(spark, sf_dir):
    return published(front.frontier(_points(spark, sf_dir)))


@query
def frontier_best(spark, sf_dir):
    return published(front.best_with_delta(_points(spark, sf_dir)))


def _sensitivity(spark, sf_dir, targets=fixed.FRONTIER_QUANTILES, **ranges):
    train, test = data.scored_split(spark, sf_dir)
    return sens.sensitivity(front.frontier_measures(train, test, targets), **ranges)


@query
def sensitivity_lgd(spark, sf_dir):
    return published(_sensitivity(spark, sf_dir, opex=[], capital=[]))


@query
def sensitivity(spark, sf_dir):
    return published(_sensitivity(spark, sf_dir))


@query
def sensitivity_fine(spark, sf_dir):
    return published(_sensitivity(spark, sf_dir, fixed.FINE_QUANTILES))


@query
def sensitivity_screen(spark, sf_dir):
    return published(_sensitivity(spark, sf_dir, fixed.SCREEN_QUANTILES))


@query
def robustness(spark, sf_dir):
    return published(sens.robustness(_sensitivity(spark, sf_dir)))


@query
def optimum_stability(spark, sf_dir):
    return sens.optimum_stability(_sensitivity(spark, sf_dir, fixed.FINE_QUANTILES))


# Parity

@query
def proxy_probability(spark, sf_dir):
    return parity.with_proxy_probability(data.clean(spark, sf_dir)).select(
        "loan_id", "addr_state", "geo_proxy_probability")


@query
def assign_proxy(spark, sf_dir):
    return parity.assign_proxy(data.clean(spark, sf_dir)).select("loan_id", parity.GROUP)


@query
def proxy_counts(spark, sf_dir):
    return parity.proxy_counts(parity.assign_proxy(data.clean(spark, sf_dir)))


@query
def parity_screen(spark, sf_dir):
    train, test = data.scored_split(spark, sf_dir)
    return published(parity.parity_screen(parity.assign_proxy(test), ev.three_policies(train)))


# Drift

def _psi(spark, sf_dir, numeric, categorical):
    train, test = features.time_split(data.prepared(spark, sf_dir))
    return drift.psi_report(train, test, numeric, categorical)


@query
def psi_numeric(spark, sf_dir):
    return published(_psi(spark, sf_dir, fixed.NUMERIC_FEATURES, []))


@query
def psi_categorical(spark, sf_dir):
    return published(_psi(spark, sf_dir, [], fixed.CATEGORICAL_FEATURES))


@query
def psi_report(spark, sf_dir):
    return published(_psi(spark, sf_dir, fixed.NUMERIC_FEATURES, fixed.CATEGORICAL_FEATURES))


@query
def psi_status_summary(spark, sf_dir):
    return drift.status_summary(
        _psi(spark, sf_dir, fixed.NUMERIC_FEATURES, fixed.CATEGORICAL_FEATURES))


def _event_baseline(spark, sf_dir):
    """Events and the profile of those before DRIFT_START.

    Event times carry no zone. A stream's watermark needs instants, so the stream reads its clock
    as UTC whatever the session's zone.
    """
    path = f"{sf_dir}/events.parquet"
    events = spark.read.parquet(path)
    before = events.filter(F.col("ts") < F.lit(DRIFT_START).cast("timestamp_ntz"))
    folder = stage_path(spark, "event_baseline", input_fingerprint(spark, path))
    return events, live.Baseline.of(before, ["value"], ["event_type"], folder)


def _window_rows(scores):
    return published(scores.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
        "feature", "type", "psi", "status"))


@query
def psi_windowed(spark, sf_dir):
    events, baseline = _event_baseline(spark, sf_dir)
    current = events.filter(F.col("ts") >= F.lit(DRIFT_START).cast("timestamp_ntz"))
    counts = staged(spark, "window_counts", input_fingerprint(spark, f"{sf_dir}/events.parquet"),
                    lambda: live.window_counts(current, baseline, "ts", "1 day"))
    return _window_rows(live.score_windows(counts, baseline))


@query
def psi_stream(spark, sf_dir):
    events, baseline = _event_baseline(spark, sf_dir)
    stream = spark.readStream.schema(events.schema).option(
        "pathGlobFilter", "events.parquet").parquet(sf_dir)
    current = stream.filter(F.col("ts") >= F.lit(DRIFT_START).cast("timestamp_ntz")).withColumn(
        "ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    mark = input_fingerprint(spark, f"{sf_dir}/events.parquet")
    output = stage_path(spark, "drift_windows", mark)
    live.start_drift_stream(current, baseline, output, stage_path(spark, "drift_state", mark),
                            once=True).awaitTermination()
    shown = F.to_utc_timestamp(F.col("window_start"), F.current_timezone())
    scores = live.read_drift(spark, output, baseline).drop("final")
    return _window_rows(scores.withColumn("window_start", shown))


# Dashboard

@query
def overview(spark, sf_dir):
    train, test = data.scored_split(spark, sf_dir)
    return published(ev.overview(data.clean(spark, sf_dir), train, test))
