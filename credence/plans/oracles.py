"""SQL that recomputes each named query independently, straight from the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from credence import fixed_values as fixed
from credence.plans.registry import DRIFT_START, SAMPLE, WHAT_IF_TARGET


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _doubles(values: Sequence[float]) -> str:
    return "[" + ", ".join(_double(v) for v in values) + "]"


def _texts(values: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_STATES = "CA TX NY FL IL GA NC OH PA MI WA OR AZ NV CO UT NJ VA MA MN WI MO TN AL SC"

RAW = f"""
keys AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, CAST(l_linenumber AS BIGINT) AS ln,
         CAST(l_quantity AS INTEGER) AS q, CAST(round(100 * l_extendedprice) AS BIGINT) AS cents,
         CAST(round(100 * l_discount) AS INTEGER) AS d, CAST(round(100 * l_tax) AS INTEGER) AS t,
         l_returnflag, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS ordered,
         CAST(o_orderdate AS DATE) + INTERVAL 192 MONTH AS issued,
         c_custkey, c_nationkey, c_acctbal, c_mktsegment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
hashed AS (
  SELECT *, (ok * 7919 + pk * 104729 + sk * 1299709 + ln * 15485863) % 1000 AS h,
         (7 * pk + 3 * sk + ok) % 61 AS k, (3 * pk + ok) % 1000 AS u,
         660 + 5 * ((31 * c_custkey + 17 * pk + 7 * ok) % 38) AS low,
         700 + 150 * d + 25 * t AS rate
  FROM keys),
once AS (
  SELECT ok, concat_ws('-', ok, ln, pk, sk, cents) AS loan_id,
    CAST(cents // 400 AS DOUBLE) AS loan_amnt,
    CASE WHEN (pk + ln) % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
    (rate // 100) || '.' || lpad(CAST(rate % 100 AS VARCHAR), 2, '0') || '%' AS int_rate,
    substr('ABCCDDDEEFG', d + 1, 1) AS grade,
    substr('ABCCDDDEEFG', d + 1, 1) || (t % 5 + 1) AS sub_grade,
    CASE q % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
      WHEN 11 THEN 'n/a' ELSE (q % 12) || ' years' END AS emp_length,
    CASE WHEN ok % 97 = 0 THEN NULL
      ELSE round(20000 + 10 * (c_acctbal + 1000), 2) END AS annual_inc,
    CAST((13 * pk + 7 * sk + ok) % 2500
      + CASE WHEN ordered >= DATE '1999-01-01' THEN 800 ELSE 0 END AS DOUBLE) / 100 AS dti,
    CASE WHEN o_orderstatus = 'P' AND pk % 4 = 0 THEN 'Current'
      WHEN o_orderstatus = 'O' AND pk % 29 = 0 THEN 'Late (31-120 days)'
      WHEN h < 350 - (low - 660) + 10 * d THEN
        CASE WHEN h % 10 = 0 THEN 'Default' ELSE 'Charged Off' END
      ELSE 'Fully Paid' END AS loan_status,
    CASE WHEN pk % 211 = 0 THEN NULL ELSE CASE c_mktsegment
      WHEN 'MACHINERY' THEN 'small_business' WHEN 'FURNITURE' THEN 'home_improvement'
      WHEN 'BUILDING' THEN 'debt_consolidation' WHEN 'AUTOMOBILE' THEN 'car'
      WHEN 'HOUSEHOLD' THEN 'credit_card' END END AS purpose,
    CAST(low AS DOUBLE) AS fico_range_low, CAST(low + 4 AS DOUBLE) AS fico_range_high,
    strftime(issued, '%b-%Y') AS issue_d,
    CASE WHEN k = 60 THEN NULL WHEN k = 59 THEN strftime(issued - INTERVAL 1 MONTH, '%b-%Y')
      ELSE strftime(issued + to_months(CAST(k AS INTEGER)), '%b-%Y') END AS last_pymnt_d,
    CASE WHEN u % 89 = 0 THEN NULL ELSE (u // 10) || '.' || (u % 10) || '%' END AS revol_util,
    CAST((pk + sk) % 4 AS DOUBLE) AS delinq_2yrs, CAST(2 + pk % 18 AS DOUBLE) AS open_acc,
    CASE WHEN sk % 9 = 0 THEN 1e0 ELSE 0e0 END AS pub_rec,
    CAST((ok + ln) % 4 AS DOUBLE) AS inq_last_6mths, CAST(ln % 4 AS DOUBLE) AS mort_acc,
    CAST(5 + pk % 30 AS DOUBLE) AS total_acc,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'RENT' WHEN '2' THEN 'MORTGAGE'
      WHEN '3' THEN 'OWN' WHEN '4' THEN 'ANY' ELSE 'NONE' END AS home_ownership,
    CASE l_returnflag WHEN 'R' THEN 'Verified' WHEN 'A' THEN 'Not Verified'
      ELSE 'Source Verified' END AS verification_status,
    split_part('{_STATES}', ' ', c_nationkey + 1) AS addr_state
  FROM hashed),
raw AS (
  SELECT * EXCLUDE (ok) FROM once
  UNION ALL SELECT * EXCLUDE (ok) FROM once WHERE ok % 50 = 0)"""

_MONTHS_ON_BOOK = """(date_diff('month', strptime(issue_d, '%b-%Y'),
  strptime(last_pymnt_d, '%b-%Y')))"""
_GRADE = f"grade IN {_texts(fixed.SCOPED_GRADES)}"
_STATUS = f"loan_status IN {_texts(fixed.GOOD_STATUSES + fixed.BAD_STATUSES)}"
_YEAR = f"year(strptime(issue_d, '%b-%Y')) >= {fixed.MIN_ISSUE_YEAR}"
_MONTHS = f"{_MONTHS_ON_BOOK} >= 0"
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [
    "loan_amnt", "term", "int_rate", "annual_inc", "dti", "fico_range_low", "fico_range_high",
    "revol_util", "delinq_2yrs", "open_acc", "pub_rec", "inq_last_6mths", "mort_acc",
    "total_acc"])
_FILTERS = [_GRADE, _STATUS, _YEAR, _MONTHS, _COMPLETE]

CLEAN = RAW + f""",
clean AS (
  SELECT *, CAST(regexp_extract(term, '[0-9]+') AS DOUBLE) AS term_months,
    CAST(replace(int_rate, '%', '') AS DOUBLE) / 100 AS int_rate_frac,
    CASE WHEN emp_length = 'n/a' THEN NULL WHEN emp_length LIKE '<%' THEN 0e0
      ELSE CAST(regexp_extract(emp_length, '[0-9]+') AS DOUBLE) END AS emp_length_years,
    CAST(replace(revol_util, '%', '') AS DOUBLE) / 100 AS revol_util_frac,
    {_MONTHS_ON_BOOK} AS months_on_book,
    CASE WHEN loan_status IN {_texts(fixed.BAD_STATUSES)} THEN 1 ELSE 0 END AS defaulted,
    (fico_range_low + fico_range_high) / 2 AS fico_avg,
    CAST(strptime(issue_d, '%b-%Y') AS DATE) AS issue_date,
    year(strptime(issue_d, '%b-%Y')) AS issue_year
  FROM (SELECT DISTINCT * FROM raw WHERE {' AND '.join(_FILTERS)}))"""

_Z = ("(-0.80e0 + -0.004e0 * (fico_avg - 752) + 0.012e0 * (dti - 16) + 0.05e0 * inq_last_6mths"
      " + -0.03e0 * mort_acc + CASE WHEN term_months = 60 THEN 0.15e0 ELSE 0e0 END"
      " + CASE WHEN home_ownership = 'RENT' THEN 0.10e0 ELSE 0e0 END"
      " + CASE WHEN purpose = 'car' THEN -0.05e0 ELSE 0e0 END)")
_PAYMENT = ("(loan_amnt * (int_rate_frac / 12) * pow(1 + int_rate_frac / 12, term_months)"
            " / (pow(1 + int_rate_frac / 12, term_months) - 1))")
_INTEREST = f"({_PAYMENT} * term_months - loan_amnt)"

SCORED = CLEAN + f""",
scored AS (
  SELECT *, floor(1 / (1 + exp(-{_Z})) * 1e9 + 0.5e0) / 1e9 AS pd,
    {_INTEREST} / (term_months / 12) AS yearly_interest,
    loan_amnt * defaulted / (term_months / 12) AS yearly_defaulted
  FROM clean),
train AS (SELECT * FROM scored WHERE issue_date < DATE '{fixed.SPLIT_DATE}'),
test AS (SELECT * FROM scored WHERE issue_date >= DATE '{fixed.SPLIT_DATE}')"""


def _fico_cutoffs(targets: Sequence[float]) -> str:
    return (f"SELECT unnest({_doubles(targets)}) AS target, unnest(quantile_cont(fico_avg, "
            f"{_doubles([1 - t for t in targets])})) AS cutoff FROM train")


def _pd_cutoffs(targets: Sequence[float]) -> str:
    return (f"SELECT unnest({_doubles(targets)}) AS target, "
            f"unnest(quantile_cont(pd, {_doubles(targets)})) AS cutoff FROM train")


def _sums(population: str) -> str:
    """Per (policy, target, cutoff) of ``points``: sums over the loans it approves."""
    return f"""
sums AS (
  SELECT policy, target, cutoff, count(loan_id) AS n,
    (SELECT count(*) FROM {population}) AS loans,
    coalesce(sum(loan_amnt), 0e0) AS lent, coalesce(sum(yearly_interest), 0e0) AS interest,
    coalesce(sum(yearly_defaulted), 0e0) AS yearly_defaulted,
    coalesce(sum(loan_amnt * defaulted), 0e0) AS defaulted_amount
  FROM points LEFT JOIN {population}
    ON (policy LIKE 'champion%' AND fico_avg >= cutoff)
    OR (policy LIKE 'challenger%' AND pd <= cutoff)
  GROUP BY ALL)"""


def _metrics(lgd: str = "0.55e0", opex: str = "0.05e0", capital: str = "0.08e0") -> str:
    net = f"interest - {lgd} * yearly_defaulted - {opex} * lent"
    return f"""n, CASE WHEN n > 0 THEN n / loans ELSE 0e0 END AS approval_rate,
    interest AS revenue, {lgd} * yearly_defaulted AS actual_loss, {opex} * lent AS opex,
    {capital} * lent AS capital, {net} AS net_income,
    CASE WHEN n > 0 THEN ({net}) / ({capital} * lent) ELSE 0e0 END AS raroc,
    CASE WHEN n > 0 THEN {lgd} * defaulted_amount / lent ELSE 0e0 END AS loss_rate"""


_ROUNDED = """n, round(approval_rate, 6) AS approval_rate, round(revenue, 2) AS revenue,
  round(actual_loss, 2) AS actual_loss, round(opex, 2) AS opex, round(capital, 2) AS capital,
  round(net_income, 2) AS net_income, round(raroc, 6) AS raroc, round(loss_rate, 6) AS loss_rate"""

_T = fixed.TARGET_APPROVAL_RATE
_SWEEP = f""",
points AS (SELECT 'challenger' AS policy, * FROM ({_pd_cutoffs(fixed.SWEEP_QUANTILES)})),
{_sums('train')},
swept AS (SELECT target, cutoff, {_metrics()} FROM sums),
optimal AS (SELECT * FROM swept ORDER BY raroc DESC, target LIMIT 1)"""

_POLICIES = SCORED + _SWEEP.replace("sums", "train_sums").replace("points", "sweep_points") + f""",
points AS (
  SELECT 'champion' AS policy, * FROM ({_fico_cutoffs([_T])})
  UNION ALL SELECT 'challenger_volume_matched', * FROM ({_pd_cutoffs([_T])})
  UNION ALL SELECT 'challenger_raroc_optimized', target, cutoff FROM optimal)"""
_COMPARED = _POLICIES + "," + _sums("test") + f""",
compared AS (SELECT policy, {_metrics()} FROM sums)"""


def _frontier(targets: Sequence[float]) -> str:
    return SCORED + f""",
points AS (
  SELECT 'champion' AS policy, * FROM ({_fico_cutoffs(targets)})
  UNION ALL SELECT 'challenger', * FROM ({_pd_cutoffs(targets)})),
{_sums('test')},
front AS (SELECT policy, target, cutoff, {_metrics()} FROM sums)"""


_FRONTIER = _frontier(fixed.FRONTIER_QUANTILES)
_FRONT_ROWS = f"policy, round(target, 9) AS target_quantile, round(cutoff, 9) AS cutoff, {_ROUNDED}"
_BEST = """,
best AS (
  SELECT * FROM front
  QUALIFY row_number() OVER (PARTITION BY policy ORDER BY raroc DESC, target) = 1)"""


def _sensitivity(targets: Sequence[float]) -> str:
    base = {"lgd": fixed.LGD, "opex_rate": fixed.OPEX_RATE, "capital_rate": fixed.CAPITAL_RATE}
    ranges = {"lgd": fixed.LGD_RANGE, "opex_rate": fixed.OPEX_RANGE,
              "capital_rate": fixed.CAPITAL_RANGE}
    settings = []
    for parameter, values in ranges.items():
        for value in values:
            used = {**base, parameter: value}
            settings.append(f"('{parameter}', {_double(value)}, "
                            + ", ".join(_double(v) for v in used.values()) + ")")
    return _frontier(targets) + f""",
settings(parameter, value, lgd, opex_rate, capital_rate) AS (VALUES {', '.join(settings)}),
tried AS (
  SELECT parameter, value, policy, target,
    CASE WHEN n > 0 THEN (interest - lgd * yearly_defaulted - opex_rate * lent)
      / (capital_rate * lent) ELSE 0e0 END AS raroc,
    CASE WHEN n > 0 THEN n / loans ELSE 0e0 END AS approval
  FROM sums, settings),
tops AS (
  SELECT * FROM tried QUALIFY
    row_number() OVER (PARTITION BY parameter, value, policy ORDER BY raroc DESC, target) = 1),
sens AS (
  SELECT parameter, value, c.raroc AS champion_raroc, c.approval AS champion_approval,
    m.raroc AS challenger_raroc, m.approval AS challenger_approval
  FROM (SELECT * FROM tops WHERE policy = 'champion') c
  JOIN (SELECT * FROM tops WHERE policy = 'challenger') m USING (parameter, value))"""


_SENSITIVITY_ROWS = """parameter AS swept_parameter, round(value, 9) AS parameter_value,
  round(champion_raroc, 6) AS champion_best_raroc,
  round(champion_approval, 6) AS champion_best_approval_rate,
  round(challenger_raroc, 6) AS challenger_best_raroc,
  round(challenger_approval, 6) AS challenger_best_approval_rate,
  round(challenger_raroc - champion_raroc, 6) AS delta_challenger_minus_champion,
  champion_raroc >= challenger_raroc AS champion_wins"""

_PROBABILITY = ("CASE addr_state " + " ".join(
    f"WHEN '{s}' THEN {_double(p)}" for s, p in fixed.STATE_PROBABILITY.items())
    + f" ELSE {_double(fixed.DEFAULT_STATE_PROBABILITY)} END")
_DRAW = (f"(CAST('0x' || substr(md5('{fixed.SEED}:' || loan_id), 1, 13) AS BIGINT)"
         " / 4503599627370496e0)")
_GROUP = f"CASE WHEN {_DRAW} < {_PROBABILITY} THEN 'Group B' ELSE 'Group A' END"

_MEDIAN = "(SELECT quantile_cont({0}, 0.5) FROM clean)"
_PREPARED = SCORED + f""",
prepared AS (
  SELECT * REPLACE (
    coalesce(emp_length_years, {_MEDIAN.format('emp_length_years')}) AS emp_length_years,
    coalesce(revol_util_frac, {_MEDIAN.format('revol_util_frac')}) AS revol_util_frac,
    coalesce(purpose, 'UNKNOWN') AS purpose,
    coalesce(home_ownership, 'UNKNOWN') AS home_ownership,
    coalesce(verification_status, 'UNKNOWN') AS verification_status),
    issue_date < DATE '{fixed.SPLIT_DATE}' AS base
  FROM scored)"""
_MODEL_TRAIN = "model_train AS (SELECT * FROM prepared WHERE base)"


def _psi_sql(groups: str, source: str) -> str:
    """PSI over ``source`` (groups, base, feature, bin), every bin of either side included."""
    keys = f"{groups}, " if groups else ""
    return f"""
psi_counts AS (
  SELECT {keys}feature, type, bin, count(*) FILTER (base) AS e, count(*) FILTER (NOT base) AS a
  FROM {source} GROUP BY ALL),
psi_shares AS (
  SELECT {keys}feature, type,
    greatest(e / sum(e) OVER (PARTITION BY {keys}feature), 1e-6) AS es,
    greatest(a / sum(a) OVER (PARTITION BY {keys}feature), 1e-6) AS acs
  FROM psi_counts),
psi_values AS (
  SELECT {keys}feature, type, sum((acs - es) * ln(acs / es)) AS psi
  FROM psi_shares GROUP BY ALL)"""


_STATUS_CASE = ("CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift'"
                " ELSE 'significant_shift' END")


def _psi_report(numeric: Sequence[str], categorical: Sequence[str]) -> str:
    parts = [f"""SELECT base, '{f}' AS feature, 'numeric' AS type, CAST(len(list_filter(edges,
      lambda edge: edge < v)) AS VARCHAR) AS bin FROM (
      SELECT base, CAST({f} AS DOUBLE) AS v, (SELECT CASE WHEN len(x) < 3 THEN []
        ELSE x[2:-2] END FROM (SELECT list_sort(list_distinct(quantile_cont(
          CAST({f} AS DOUBLE), {_doubles(fixed.linspace(0.0, 1.0, 11))}))) AS x
          FROM prepared WHERE base)) AS edges FROM prepared) WHERE v IS NOT NULL"""
             for f in numeric]
    parts += [f"SELECT base, '{f}' AS feature, 'categorical' AS type, {f} AS bin FROM prepared"
              for f in categorical]
    return (_PREPARED + ",\nbins AS (" + "\nUNION ALL ".join(parts) + "),"
            + _psi_sql("", "bins") + f""",
report AS (SELECT feature, type, round(psi, 6) AS psi, {_STATUS_CASE} AS status
  FROM psi_values)""")


_EVENT_PSI = f"""
base_edges AS (
  SELECT x[2:-2] AS edges FROM (SELECT list_sort(list_distinct(quantile_cont(value,
    {_doubles(fixed.linspace(0.0, 1.0, 11))}))) AS x
  FROM events WHERE ts < TIMESTAMP '{DRIFT_START}')),
event_bins AS (
  SELECT ts, 'value' AS feature, 'numeric' AS type,
    CAST(len(list_filter(edges, lambda edge: edge < value)) AS VARCHAR) AS bin
  FROM events, base_edges WHERE value IS NOT NULL
  UNION ALL SELECT ts, 'event_type', 'categorical', event_type FROM events
  WHERE event_type IS NOT NULL),
days AS (SELECT DISTINCT date_trunc('day', ts) AS day FROM events
  WHERE ts >= TIMESTAMP '{DRIFT_START}'),
day_bins AS (
  SELECT date_trunc('day', ts) AS day, false AS base, feature, type, bin FROM event_bins
  WHERE ts >= TIMESTAMP '{DRIFT_START}'
  UNION ALL SELECT day, true, feature, type, bin FROM days, event_bins
  WHERE ts < TIMESTAMP '{DRIFT_START}'),""" + _psi_sql("day", "day_bins")
_EVENT_ROWS = f"""SELECT strftime(day, '%Y-%m-%d') AS window_start, feature, type,
  round(psi, 6) AS psi, {_STATUS_CASE} AS status FROM psi_values"""

_SPLIT = "issue_date {} DATE '" + fixed.SPLIT_DATE + "'"


def _raw_rows(condition: str) -> str:
    return (f"WITH {RAW} SELECT loan_id, grade, loan_status, issue_d, last_pymnt_d FROM raw "
            f"WHERE {condition}")


def _funnel() -> str:
    names = ["filter_grade", "filter_loan_status", "filter_platform_maturity",
             "filter_invalid_months_on_book", "drop_incomplete_rows"]
    counts = ["(SELECT count(*) FROM raw) AS n0"]
    for i in range(len(_FILTERS)):
        counts.append(f"(SELECT count(*) FROM raw WHERE {' AND '.join(_FILTERS[:i + 1])}) "
                      f"AS n{i + 1}")
    counts.append("(SELECT count(*) FROM clean) AS n6")
    rows = [f"SELECT CAST({i + 1} AS BIGINT) AS step_no, '{name}' AS step, n{i} AS rows_in, "
            f"n{i + 1} AS rows_out FROM counts" for i, name in enumerate([*names, "dedupe"])]
    return (f"WITH {CLEAN}, counts AS (SELECT {', '.join(counts)}) "
            + " UNION ALL ".join(rows))


def _decision(columns: str, approved: str) -> str:
    return f"SELECT loan_id, {columns}, {approved} AS approved FROM test"


_FICO_CUT = f"(SELECT cutoff FROM ({_fico_cutoffs([_T])}))"
_PD_CUT = f"(SELECT cutoff FROM ({_pd_cutoffs([_T])}))"

ORACLES: dict[str, str] = {
    "scan_raw_loans": f"""WITH {RAW} SELECT loan_id, grade, term, int_rate,
        CASE WHEN emp_length <> 'n/a' THEN emp_length END AS emp_length, home_ownership, purpose,
        revol_util, last_pymnt_d, annual_inc, dti FROM raw""",
    "ingest_funnel": _funnel(),
    "ingest_log": _funnel(),
    "demo_sample": f"""WITH {CLEAN} SELECT loan_id, grade, issue_d, fico_avg, defaulted
        FROM clean ORDER BY {_DRAW}, loan_id LIMIT {SAMPLE}""",
    "loans_per_issue_year": f"""WITH {CLEAN} SELECT issue_year, count(*) AS loans FROM clean
        GROUP BY issue_year""",
    "filter_grade": _raw_rows(_GRADE),
    "filter_matured": _raw_rows(_STATUS),
    "filter_issue_year": _raw_rows(_YEAR),
    "filter_valid_mob": _raw_rows(_MONTHS),
    "drop_incomplete": _raw_rows(_COMPLETE),
    "dedupe_loans": f"""WITH {RAW}, d AS (SELECT DISTINCT * FROM raw)
        SELECT loan_id, loan_amnt, annual_inc, purpose, addr_state FROM d""",
    "clean_loans": f"""WITH {CLEAN} SELECT * EXCLUDE (issue_date) REPLACE (
        CAST(defaulted AS BIGINT) AS defaulted) FROM clean""",
    "stored_loans": f"WITH {CLEAN} SELECT loan_id, issue_year, fico_avg, false AS is_sample "
                    "FROM clean",
    "time_split_counts": f"""WITH {CLEAN} SELECT
        CASE WHEN {_SPLIT.format('<')} THEN 'train' ELSE 'test' END AS side, count(*) AS loans,
        round(avg(defaulted), 6) AS default_rate,
        strftime(min(issue_date), '%Y-%m-%d') AS first_issue,
        strftime(max(issue_date), '%Y-%m-%d') AS last_issue FROM clean GROUP BY 1""",
    "impute_median": f"""WITH {_PREPARED} SELECT loan_id, emp_length_years,
        revol_util_frac FROM prepared""",
    "fill_unknown": f"""WITH {_PREPARED} SELECT loan_id, purpose, home_ownership,
        verification_status FROM prepared""",
    "champion_fixed_cutoff": f"WITH {SCORED} {_decision('fico_avg', 'fico_avg >= 660')}",
    "champion_cutoff": f"WITH {SCORED} SELECT target AS target_rate, cutoff FROM "
                       f"({_fico_cutoffs([_T])})",
    "champion_volume_matched": f"WITH {SCORED} {_decision('fico_avg', f'fico_avg >= {_FICO_CUT}')}",
    "score_scorecard": f"WITH {SCORED} SELECT loan_id, pd FROM scored",
    "challenger_fixed_threshold": f"WITH {SCORED} {_decision('pd', 'pd <= 0.35e0')}",
    "challenger_threshold": f"WITH {SCORED} SELECT target AS target_rate, "
                            f"round(cutoff, 9) AS cutoff FROM ({_pd_cutoffs([_T])})",
    "challenger_volume_matched": f"WITH {SCORED} {_decision('pd', f'pd <= {_PD_CUT}')}",
    "pd_threshold_sweep": f"""WITH {SCORED} {_SWEEP} SELECT round(target, 9) AS target_quantile,
        round(cutoff, 9) AS pd_threshold, {_ROUNDED} FROM swept""",
    "raroc_optimal_threshold": f"""WITH {SCORED} {_SWEEP} SELECT
        round(target, 9) AS target_quantile, round(cutoff, 9) AS pd_threshold,
        round(raroc, 6) AS raroc FROM optimal""",
    "challenger_raroc_optimized": f"WITH {SCORED} {_SWEEP} "
        + _decision("pd", "pd <= (SELECT cutoff FROM optimal)"),
    "model_optimality": f"WITH {_PREPARED}, {_MODEL_TRAIN} " + " UNION ALL ".join(
        ["SELECT 'intercept' AS feature, CAST(NULL AS VARCHAR) AS category, count(*) AS loans, "
         "round(avg(defaulted), 4) AS explained FROM model_train"]
        + [f"SELECT '{f}', NULL, count({f}), round((avg(defaulted * {f}) - avg(defaulted) * avg({f}))"
           f" / stddev_pop({f}), 4) FROM model_train" for f in fixed.NUMERIC_FEATURES]
        + [f"SELECT '{f}', {f}, count(*), round(sum(defaulted) / (SELECT count(*) FROM "
           f"model_train), 4) FROM model_train GROUP BY {f}" for f in fixed.CATEGORICAL_FEATURES]),
    "model_calibration": f"WITH {_PREPARED}, {_MODEL_TRAIN} SELECT count(*) AS loans, "
        "CAST(sum(defaulted) AS DOUBLE) AS expected, CAST(sum(defaulted) AS BIGINT) AS observed "
        "FROM model_train",
    "ranking_quality": f"""WITH {SCORED},
        scores AS (SELECT pd, sum(defaulted) AS bad, count(*) - sum(defaulted) AS good
          FROM test GROUP BY pd),
        runs AS (SELECT *, sum(bad) OVER w AS bad_run, sum(good) OVER w AS good_run,
            sum(bad) OVER () AS bads, sum(good) OVER () AS goods
          FROM scores WINDOW w AS (ORDER BY pd)),
        quality AS (SELECT sum(CAST(bad AS DOUBLE) * (good_run - good + good / 2e0))
            / (max(CAST(bads AS DOUBLE)) * max(goods)) AS auc,
          max(abs(bad_run / bads - good_run / goods)) AS ks FROM runs)
        SELECT round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini, round(ks, 6) AS ks
        FROM quality""",
    "interest_by_term_grade": f"""WITH {CLEAN} SELECT term_months, grade, count(*) AS loans,
        round(sum(loan_amnt), 2) AS lent, round(sum({_INTEREST}), 2) AS interest
        FROM clean GROUP BY term_months, grade""",
    "raroc_champion": f"""WITH {SCORED}, points AS (SELECT 'champion' AS policy, *
        FROM ({_fico_cutoffs([_T])})), {_sums('test')}, m AS (SELECT policy, {_metrics()} FROM sums)
        SELECT policy, {_ROUNDED} FROM m""",
    "raroc_challenger": f"""WITH {SCORED}, points AS (SELECT 'challenger' AS policy, *
        FROM ({_pd_cutoffs([_T])})), {_sums('test')}, m AS (SELECT policy, {_metrics()} FROM sums)
        SELECT policy, {_ROUNDED} FROM m""",
    "policy_comparison": f"WITH {_COMPARED} SELECT policy, {_ROUNDED} FROM compared",
    "policy_delta": f"""WITH {_COMPARED} SELECT o.n - c.n AS n_delta,
        round(o.approval_rate - c.approval_rate, 6) AS approval_rate_delta,
        round(o.loss_rate - c.loss_rate, 6) AS loss_rate_delta,
        round(o.raroc - c.raroc, 6) AS raroc_delta
        FROM compared o, compared c
        WHERE o.policy = 'challenger_raroc_optimized' AND c.policy = 'champion'""",
    "what_if_target_rate": f"""WITH {SCORED}, points AS (
        SELECT 'champion' AS policy, * FROM ({_fico_cutoffs([WHAT_IF_TARGET])})
        UNION ALL SELECT 'challenger', * FROM ({_pd_cutoffs([WHAT_IF_TARGET])})),
        {_sums('test')}, m AS (SELECT policy, target, cutoff, {_metrics()} FROM sums)
        SELECT policy, {_ROUNDED}, round(cutoff, 9) AS cutoff, target AS target_rate FROM m""",
    "swap_set": f"""WITH {SCORED} SELECT fico_avg >= {_FICO_CUT} AS champion_approved,
        pd <= {_PD_CUT} AS challenger_approved, count(*) AS n,
        round(avg(defaulted), 6) AS default_rate,
        round(0.55e0 * sum(loan_amnt * defaulted) / sum(loan_amnt), 6) AS loss_rate,
        round(avg(int_rate_frac), 6) AS mean_rate, round(avg(loan_amnt), 6) AS mean_amount,
        round(avg(term_months), 6) AS mean_term FROM test GROUP BY 1, 2""",
    "vintage_curve": f"""WITH {CLEAN},
        sizes AS (SELECT issue_year, count(*) AS size FROM clean GROUP BY issue_year),
        months AS (SELECT unnest(range(0, 61)) AS month)
        SELECT s.issue_year, m.month, round(count(c.loan_id) / max(s.size), 6)
          AS cumulative_default_rate, count(c.loan_id) AS cumulative_defaults,
          max(s.size) AS vintage_size
        FROM sizes s CROSS JOIN months m LEFT JOIN clean c ON c.issue_year = s.issue_year
          AND c.defaulted = 1 AND c.months_on_book <= m.month
        GROUP BY s.issue_year, m.month""",
    "vintage_summary": f"""WITH {CLEAN} SELECT issue_year, count(*) AS vintage_size,
        round(avg(defaulted), 6) AS ultimate_default_rate,
        median(months_on_book) FILTER (defaulted = 1) AS median_months_to_default
        FROM clean GROUP BY issue_year""",
    "frontier_champion": f"WITH {_FRONTIER} SELECT {_FRONT_ROWS} FROM front "
                         "WHERE policy = 'champion'",
    "frontier_challenger": f"WITH {_FRONTIER} SELECT {_FRONT_ROWS} FROM front "
                           "WHERE policy = 'challenger'",
    "frontier": f"""WITH {_FRONTIER} SELECT round(c.target, 9) AS target_quantile,
        round(c.cutoff, 9) AS champion_fico_cutoff,
        round(c.approval_rate, 6) AS champion_approval_rate,
        round(c.raroc, 6) AS champion_raroc, round(c.loss_rate, 6) AS champion_loss_rate,
        round(m.cutoff, 9) AS challenger_pd_threshold,
        round(m.approval_rate, 6) AS challenger_approval_rate,
        round(m.raroc, 6) AS challenger_raroc, round(m.loss_rate, 6) AS challenger_loss_rate
        FROM (SELECT * FROM front WHERE policy = 'champion') c
        JOIN (SELECT * FROM front WHERE policy = 'challenger') m USING (target)""",
    "frontier_best": f"""WITH {_FRONTIER} {_BEST} SELECT {_FRONT_ROWS},
        round((SELECT raroc FROM best WHERE policy = 'challenger')
          - (SELECT raroc FROM best WHERE policy = 'champion'), 6)
          AS delta_challenger_minus_champion FROM best""",
    "sensitivity_lgd": f"WITH {_sensitivity(fixed.FRONTIER_QUANTILES)} "
                       f"SELECT {_SENSITIVITY_ROWS} FROM sens WHERE parameter = 'lgd'",
    "sensitivity": f"WITH {_sensitivity(fixed.FRONTIER_QUANTILES)} "
                   f"SELECT {_SENSITIVITY_ROWS} FROM sens",
    "sensitivity_fine": f"WITH {_sensitivity(fixed.FINE_QUANTILES)} "
                        f"SELECT {_SENSITIVITY_ROWS} FROM sens",
    "sensitivity_screen": f"WITH {_sensitivity(fixed.SCREEN_QUANTILES)} "
                          f"SELECT {_SENSITIVITY_ROWS} FROM sens",
    "robustness": f"""WITH {_sensitivity(fixed.FRONTIER_QUANTILES)}
        SELECT parameter AS swept_parameter,
          CASE WHEN bool_and(champion_raroc >= challenger_raroc) THEN 'champion_always_wins'
            WHEN NOT bool_or(champion_raroc >= challenger_raroc) THEN 'challenger_always_wins'
            ELSE 'conclusion_depends_on_assumption' END AS robustness,
          round(min(challenger_raroc - champion_raroc), 6) AS min_delta,
          round(max(challenger_raroc - champion_raroc), 6) AS max_delta
        FROM sens GROUP BY parameter""",
    "optimum_stability": f"""WITH {_sensitivity(fixed.FINE_QUANTILES)},
        rates AS (SELECT DISTINCT policy, round(approval, 4) AS rate FROM tops)
        SELECT policy, count(*) AS distinct_rates,
          string_agg(CAST(rate AS VARCHAR), ', ' ORDER BY rate) AS rates,
          count(*) = 1 AS stable FROM rates GROUP BY policy""",
    "proxy_probability": f"WITH {CLEAN} SELECT loan_id, addr_state, {_PROBABILITY} "
                         "AS geo_proxy_probability FROM clean",
    "assign_proxy": f"WITH {CLEAN} SELECT loan_id, {_GROUP} AS protected_class_proxy FROM clean",
    "proxy_counts": f"WITH {CLEAN} SELECT {_GROUP} AS protected_class_proxy, count(*) AS loans "
                    "FROM clean GROUP BY 1",
    "parity_screen": f"""WITH {_POLICIES},
        grouped AS (SELECT *, {_GROUP} AS grp FROM test),
        rates AS (SELECT policy, grp, count(*) AS n, avg(CASE WHEN CASE WHEN policy = 'champion'
            THEN fico_avg >= cutoff ELSE pd <= cutoff END THEN 1 ELSE 0 END) AS rate
          FROM points CROSS JOIN grouped GROUP BY policy, grp),
        pairs AS (SELECT a.policy, a.rate AS ra, b.rate AS rb, a.n AS na, b.n AS nb,
            CASE WHEN a.rate = 0 AND b.rate = 0 THEN 1e0
              ELSE least(a.rate, b.rate) / greatest(a.rate, b.rate) END AS ratio
          FROM rates a JOIN rates b USING (policy)
          WHERE a.grp = 'Group A' AND b.grp = 'Group B')
        SELECT policy, round(ra, 6) AS group_a_approval_rate,
          round(rb, 6) AS group_b_approval_rate, na AS group_a_n, nb AS group_b_n,
          round(ratio, 6) AS four_fifths_ratio, ratio < 0.80 AS flagged FROM pairs""",
    "psi_numeric": f"WITH {_psi_report(fixed.NUMERIC_FEATURES, [])} SELECT * FROM report",
    "psi_categorical": f"WITH {_psi_report([], fixed.CATEGORICAL_FEATURES)} SELECT * FROM report",
    "psi_report": f"WITH {_psi_report(fixed.NUMERIC_FEATURES, fixed.CATEGORICAL_FEATURES)} "
                  "SELECT * FROM report",
    "psi_status_summary":
        f"WITH {_psi_report(fixed.NUMERIC_FEATURES, fixed.CATEGORICAL_FEATURES)} "
        "SELECT status, count(*) AS features, "
        "string_agg(feature, ', ' ORDER BY feature) AS feature_list FROM report GROUP BY status",
    "psi_windowed": f"WITH {_EVENT_PSI} {_EVENT_ROWS}",
    "psi_stream": f"WITH {_EVENT_PSI} {_EVENT_ROWS}",
    "overview": f"""WITH {_FRONTIER} {_BEST},
        scores AS (SELECT pd, sum(defaulted) AS bad, count(*) - sum(defaulted) AS good
          FROM test GROUP BY pd),
        runs AS (SELECT *, sum(bad) OVER w AS bad_run, sum(good) OVER w AS good_run,
            sum(bad) OVER () AS bads, sum(good) OVER () AS goods
          FROM scores WINDOW w AS (ORDER BY pd)),
        quality AS (SELECT sum(CAST(bad AS DOUBLE) * (good_run - good + good / 2e0))
            / (max(CAST(bads AS DOUBLE)) * max(goods)) AS auc,
          max(abs(bad_run / bads - good_run / goods)) AS ks FROM runs),
        items AS (
          SELECT 'loans' AS item, CAST(count(*) AS DOUBLE) AS value FROM clean
          UNION ALL SELECT policy || '_best_raroc', raroc FROM best
          UNION ALL SELECT policy || '_best_approval_rate', approval_rate FROM best
          UNION ALL SELECT policy || '_best_cutoff', cutoff FROM best
          UNION ALL SELECT 'auc', auc FROM quality
          UNION ALL SELECT 'gini', 2 * auc - 1 FROM quality
          UNION ALL SELECT 'ks', ks FROM quality)
        SELECT item, round(value, 6) AS value FROM items""",
}
