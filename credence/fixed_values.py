"""Fixed values that results depend on. Change one and every published number moves."""

from __future__ import annotations

# Raw columns a loan export must carry.
REQUIRED_COLUMNS = [
    "loan_amnt", "term", "int_rate", "grade", "sub_grade", "emp_length", "annual_inc", "dti",
    "loan_status", "purpose", "fico_range_low", "fico_range_high", "issue_d", "revol_util",
    "delinq_2yrs", "open_acc", "pub_rec", "inq_last_6mths", "home_ownership",
    "verification_status", "mort_acc", "total_acc", "last_pymnt_d", "addr_state",
]

# Cell texts a CSV reader treats as missing (case-sensitive; "NONE" is a real value).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Scope of the analysis.
SCOPED_GRADES = ["C", "D", "E", "F"]
GOOD_STATUSES = ["Fully Paid"]
BAD_STATUSES = ["Charged Off", "Default"]
MIN_ISSUE_YEAR = 2012
KEY_FIELDS = [
    "loan_amnt", "term_months", "int_rate_frac", "annual_inc", "dti", "fico_range_low",
    "fico_range_high", "revol_util_frac", "delinq_2yrs", "open_acc", "pub_rec",
    "inq_last_6mths", "mort_acc", "total_acc",
]

# Model inputs.
NUMERIC_FEATURES = [
    "fico_avg", "dti", "annual_inc", "emp_length_years", "term_months", "loan_amnt",
    "revol_util_frac", "delinq_2yrs", "open_acc", "pub_rec", "inq_last_6mths", "mort_acc",
    "total_acc",
]
CATEGORICAL_FEATURES = ["purpose", "home_ownership", "verification_status"]
TARGET = "defaulted"
UNKNOWN_CATEGORY = "UNKNOWN"

# Portfolio economics: loss given default, operating cost and capital per unit lent.
LGD = 0.55
OPEX_RATE = 0.05
CAPITAL_RATE = 0.08

# Policies.
CHAMPION_FICO_CUTOFF = 660.0
TARGET_APPROVAL_RATE = 0.85
SPLIT_DATE = "2015-01-01"

# Parity screen. The state probabilities are made up for illustration; they describe no real
# population, and nothing computed from them is evidence about one.
STATE_PROBABILITY = {
    "CA": 0.35, "TX": 0.30, "NY": 0.32, "FL": 0.28, "IL": 0.27,
    "GA": 0.33, "NC": 0.26, "OH": 0.20, "PA": 0.21, "MI": 0.22,
}
DEFAULT_STATE_PROBABILITY = 0.20
FOUR_FIFTHS = 0.80
SEED = 20260101

# Drift.
PSI_BUCKETS = 10
PSI_FLOOR = 1e-6
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25

# Vintage curve and demo sample.
CURVE_MONTHS = 60
SAMPLE_ROWS = 100_000


def linspace(start: float, stop: float, points: int) -> list[float]:
    """Evenly spaced grid; the same doubles NumPy gives."""
    if points == 1:
        return [start]
    step = (stop - start) / (points - 1)
    return [start + i * step for i in range(points - 1)] + [stop]


# Grids.
SWEEP_QUANTILES = linspace(0.05, 0.95, 19)
FRONTIER_QUANTILES = linspace(0.50, 0.99, 25)
FINE_QUANTILES = linspace(0.50, 0.99, 100)
SCREEN_QUANTILES = linspace(0.50, 0.99, 15)
LGD_RANGE = linspace(0.35, 0.75, 5)
OPEX_RANGE = linspace(0.02, 0.10, 5)
CAPITAL_RANGE = linspace(0.04, 0.12, 5)
