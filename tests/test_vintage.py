import pytest
from pyspark.sql import functions as F

from credence.operators import vintage

ROWS = [("Jan-2013", 1, 6), ("Jan-2013", 1, 12), ("Jan-2013", 0, 36), ("Jan-2013", 0, 36),
        ("Jun-2014", 1, 3), ("Jun-2014", 0, 24)]
SCHEMA = "issue_d string, defaulted int, months_on_book int"


def curve(df, year, months=36):
    rows = vintage.vintage_curve(df, months).filter(F.col("issue_year") == year).orderBy("month")
    return rows.collect()


def test_issue_year(spark):
    df = vintage.with_issue_year(spark.createDataFrame(ROWS, SCHEMA))
    assert [r.issue_year for r in df.collect()] == [2013] * 4 + [2014] * 2
    assert vintage.with_issue_year(df) is df


def test_hand_computed_curve(spark):
    rows = curve(spark.createDataFrame(ROWS, SCHEMA), 2013)
    rates = [r.cumulative_default_rate for r in rows]
    assert [r.month for r in rows] == list(range(37))
    assert set(rates[:6]) == {0.0}
    assert (rates[6], rates[12], rates[36]) == (0.25, 0.5, 0.5)
    assert rates == sorted(rates)


def test_month_edges(spark):
    rows = [("Jan-2013", 1, m) for m in (-1, 0, 60, 61, None)] + [(None, 1, 3), ("bad", 1, 3)]
    got = curve(spark.createDataFrame(rows, SCHEMA), 2013, 60)
    assert [got[m].cumulative_defaults for m in (0, 59, 60)] == [2, 2, 3]
    assert {r.vintage_size for r in got} == {5}
    assert vintage.vintage_curve(spark.createDataFrame(rows, SCHEMA)).count() == 61


def test_summary(spark):
    rows = ROWS + [("Mar-2015", 0, 5)]
    got = {r.issue_year: r for r in
           vintage.vintage_summary(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[2013].vintage_size, got[2014].vintage_size) == (4, 2)
    assert got[2013].ultimate_default_rate == got[2014].ultimate_default_rate == 0.5
    assert got[2013].median_months_to_default == pytest.approx(9)
    assert got[2015].median_months_to_default is None


def test_loans_per_year(spark):
    rows = vintage.loans_per_issue_year(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert [tuple(r) for r in rows] == [(2013, 4), (2014, 2)]
