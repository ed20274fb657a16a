import numpy as np
import pytest
from pyspark.sql import functions as F

from credence import fixed_values as fixed
from credence.functions.economics import lifetime_interest
from credence.operators import features, policies
from credence.operators import frontier as front
from credence.operators import sensitivity as sens
from credence.operators.ranking import ranking_quality
from credence.plans import evaluation as ev


def metrics(df):
    return {r.policy: r.asDict() for r in df.collect()}


def test_split_loses_nothing(loans):
    train, test = features.time_split(loans, "2015-01-01")
    assert train.count() + test.count() == loans.count()
    assert str(train.agg(F.max("issue_date")).first()[0]) < "2015-01-01"
    assert str(test.agg(F.min("issue_date")).first()[0]) >= "2015-01-01"


def test_prepare_features(loans, loans_pdf):
    prepared = features.prepare_features(loans)
    assert prepared.filter("emp_length_years is null").isEmpty()
    filled = loans.filter("emp_length_years is null").select("loan_id").join(prepared, "loan_id")
    assert {r.emp_length_years for r in filled.collect()} == {
        loans_pdf.emp_length_years.astype(float).median()}
    unknown = features.fill_unknown(loans.withColumn("purpose", F.lit(None).cast("string")))
    assert unknown.first().purpose == "UNKNOWN"
    with pytest.raises(ValueError, match="missing expected columns.*dti"):
        features.prepare_features(loans.drop("dti"))


def interest(spark, amount, rate, months):
    row = spark.range(1).select(
        lifetime_interest(F.lit(amount), F.lit(rate), F.lit(months)).alias("i"))
    return row.first().i


def test_interest(spark):
    assert interest(spark, 10000.0, 0.12, 36) == pytest.approx(1957.1515, abs=1e-3)
    assert interest(spark, 10000.0, 0.12, 60) > interest(spark, 10000.0, 0.12, 36)
    assert interest(spark, 10000.0, 0.0, 36) == 0.0


def test_raroc_against_numpy(loans, loans_pdf):
    got = metrics(policies.compare_policies(loans, {
        "all": F.lit(True), "none": policies.champion_approves(1e6)}))
    p = loans_pdf
    r, n = p.int_rate_frac / 12, p.term_months
    payment = p.loan_amnt * r * (1 + r) ** n / ((1 + r) ** n - 1)
    years = n / 12
    revenue = ((payment * n - p.loan_amnt) / years).sum()
    loss = (p.loan_amnt * p.defaulted * 0.55 / years).sum()
    net = revenue - loss - 0.05 * p.loan_amnt.sum()
    everyone = got["all"]
    assert everyone["n"] == len(p) and everyone["approval_rate"] == 1.0
    assert everyone["revenue"] == pytest.approx(revenue)
    assert everyone["actual_loss"] == pytest.approx(loss)
    assert everyone["raroc"] == pytest.approx(net / (0.08 * p.loan_amnt.sum()))
    assert everyone["loss_rate"] == pytest.approx(
        0.55 * (p.loan_amnt * p.defaulted).sum() / p.loan_amnt.sum())
    assert everyone["raroc"] < 1
    assert all(v == 0 for k, v in got["none"].items() if k != "policy")


def test_no_loans_at_all(loans):
    got = metrics(policies.compare_policies(loans.limit(0), {"all": F.lit(True)}))
    assert got["all"]["n"] == 0 and got["all"]["raroc"] == 0.0


def test_cutoffs_hit_their_target(split):
    train, test = split
    fico, pd = policies.calibrate(train, [0.85])
    rates = metrics(policies.compare_policies(train, {
        "champion": policies.champion_approves(fico[0]),
        "challenger": policies.challenger_approves(pd[0])}))
    assert rates["champion"]["approval_rate"] == pytest.approx(0.85, abs=0.03)
    assert rates["challenger"]["approval_rate"] == pytest.approx(0.85, abs=0.03)


def test_ties_at_the_cutoff_are_all_approved(spark):
    df = spark.createDataFrame([(float(x),) for x in [600] * 5 + [700] * 15], "fico_avg double")
    cutoff = policies.calibrate_fico_cutoff(df, 0.5)
    assert cutoff == 700.0
    assert df.filter(policies.champion_approves(cutoff)).count() == 15
    assert df.filter(policies.champion_approves()).count() == 15


def brute_force(train, test, policy, targets):
    """Every grid point on its own: calibrate, approve, measure."""
    points = {}
    for target in targets:
        fico, pd = policies.calibrate(train, [target])
        approve = (policies.champion_approves(fico[0]) if policy == "champion"
                   else policies.challenger_approves(pd[0]))
        points[target] = metrics(policies.compare_policies(test, {"p": approve}))["p"]
    return points


@pytest.mark.parametrize("policy", front.POLICIES)
def test_one_pass_sweep_equals_point_by_point(split, policy):
    train, test = split
    targets = fixed.linspace(0.05, 0.99, 7)
    expected = brute_force(train, test, policy, targets)
    measures = front.frontier_measures(train, test, targets)
    rows = front.frontier_points(measures).filter(F.col("policy") == policy).collect()
    assert len(rows) == 7
    for row in rows:
        for name, value in expected[row.target_quantile].items():
            if name != "policy":
                assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-9), name


def test_sweep_is_the_same_under_any_partitioning(split):
    train, test = split
    targets = fixed.linspace(0.5, 0.99, 5)
    tables = []
    for parts in (1, 17):
        points = front.frontier_points(front.frontier_measures(
            train.repartition(parts), test.repartition(parts), targets))
        tables.append([[c if isinstance(c, str) else round(c, 9) for c in row]
                       for row in points.orderBy("policy", "target_quantile").collect()])
    assert tables[0] == tables[1]


def test_frontier(split):
    points = front.frontier_points(front.frontier_measures(*split)).cache()
    rows = front.frontier(points).orderBy("target_quantile").collect()
    assert len(rows) == 25
    assert rows[-1].champion_approval_rate >= rows[0].champion_approval_rate
    assert rows[-1].challenger_approval_rate >= rows[0].challenger_approval_rate
    assert len({r.champion_fico_cutoff for r in rows}) > 1
    best = front.best_point(points, "champion").first()
    assert best.raroc == max(r.champion_raroc for r in rows)
    assert best.target_quantile == min(
        r.target_quantile for r in rows if r.champion_raroc == best.raroc)
    with pytest.raises(ValueError, match="policy must be"):
        front.best_point(points, "referee")


def test_threshold_sweep_and_its_best(split):
    train, _ = split
    sweep = ev.pd_threshold_sweep(train).cache()
    rows = sweep.collect()
    assert len(rows) == 19
    threshold = ev.raroc_optimal_threshold(train)
    best = max(rows, key=lambda r: (r.raroc, -r.target_quantile))
    assert threshold == best.pd_threshold
    matched = policies.calibrate_pd_threshold(train)
    got = metrics(policies.compare_policies(train, {
        "best": policies.challenger_approves(threshold),
        "matched": policies.challenger_approves(matched)}))
    assert got["best"]["raroc"] >= got["matched"]["raroc"] - 1e-9


def test_comparison_and_delta(split):
    train, test = split
    comparison = ev.policy_comparison(train, test)
    got = metrics(comparison)
    assert list(got) == [ev.CHAMPION, ev.VOLUME_MATCHED, ev.OPTIMIZED]
    delta = policies.policy_delta(comparison, ev.OPTIMIZED, ev.CHAMPION).first()
    assert delta.raroc_delta == pytest.approx(
        got[ev.OPTIMIZED]["raroc"] - got[ev.CHAMPION]["raroc"])
    what_if = ev.what_if(train, test, 0.85).collect()
    assert what_if[0].n == got[ev.CHAMPION]["n"]
    assert what_if[1].n == got[ev.VOLUME_MATCHED]["n"]


def test_swap_set_adds_up(split):
    _, test = split
    cells = policies.swap_set(test, policies.champion_approves(680.0),
                              policies.challenger_approves(0.25)).collect()
    assert sum(c.n for c in cells) == test.count()


def test_sensitivity_equals_reoptimised_frontiers(split):
    train, test = split
    targets = fixed.linspace(0.5, 0.99, 6)
    measures = front.frontier_measures(train, test, targets)
    rows = sens.sensitivity(measures, [0.35, 0.75], [0.03], [0.06]).collect()
    assert [(r.swept_parameter, r.parameter_value) for r in rows] == [
        ("lgd", 0.35), ("lgd", 0.75), ("opex_rate", 0.03), ("capital_rate", 0.06)]
    for row in rows:
        points = front.frontier_points(measures, **{
            **{"lgd": 0.55, "opex_rate": 0.05, "capital_rate": 0.08},
            row.swept_parameter: row.parameter_value})
        for policy in front.POLICIES:
            best = front.best_point(points, policy).first()
            assert row[f"{policy}_best_raroc"] == pytest.approx(best.raroc)
            assert row[f"{policy}_best_approval_rate"] == pytest.approx(best.approval_rate)
    assert rows[0].champion_best_raroc >= rows[1].champion_best_raroc
    assert rows[0].challenger_best_raroc >= rows[1].challenger_best_raroc


def test_robustness_classes(spark):
    rows = [("a", 0.1, -0.1, True), ("a", 0.2, -0.2, True), ("b", 0.1, 0.3, False),
            ("c", 0.1, -0.1, True), ("c", 0.2, 0.2, False)]
    df = spark.createDataFrame(rows, "swept_parameter string, parameter_value double, "
                               "delta_challenger_minus_champion double, champion_wins boolean")
    got = {r.swept_parameter: (r.robustness, r.min_delta, r.max_delta)
           for r in sens.robustness(df).collect()}
    assert got == {"a": ("champion_always_wins", -0.2, -0.1),
                   "b": ("challenger_always_wins", 0.3, 0.3),
                   "c": ("conclusion_depends_on_assumption", -0.1, 0.2)}


def ranked(spark, scores, labels):
    rows = [(float(s), int(y)) for s, y in zip(scores, labels)]
    return ranking_quality(spark.createDataFrame(rows, "pd double, defaulted int")).first()


def test_ranking_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 400)
    scores = np.round(np.clip(rng.normal(0.4, 0.2, 400) + 0.1 * labels, 0, 1), 2)
    bad, good = scores[labels == 1], scores[labels == 0]
    auc = ((bad[:, None] > good).sum() + (bad[:, None] == good).sum() / 2) / bad.size / good.size
    ks = max(abs((bad <= t).mean() - (good <= t).mean()) for t in np.unique(scores))
    got = ranked(spark, scores, labels)
    assert got.auc == pytest.approx(auc)
    assert got.gini == pytest.approx(2 * auc - 1)
    assert got.ks == pytest.approx(ks)


def test_one_class_has_no_ranking(spark):
    got = ranked(spark, [0.1, 0.2, 1.0], [1, 1, 1])
    assert (got.auc, got.gini, got.ks) == (None, None, None)


def test_interest_without_aborts(spark):
    """Zero terms, zero rates and rates too small to tell from zero earn nothing."""
    rows = spark.createDataFrame(
        [(10000.0, 0.12, 36), (10000.0, 0.12, 0), (10000.0, 0.0, 36), (10000.0, 1e-16, 36),
         (10000.0, None, 36)], "amount double, rate double, months int")
    interest = lifetime_interest(F.col("amount"), F.col("rate"), F.col("months"))
    found = [r[0] for r in rows.select(interest).collect()]
    assert found[0] == pytest.approx(1957.1515, abs=1e-3)
    assert found[1:] == [0.0, 0.0, 0.0, None]
