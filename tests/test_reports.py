import pytest
from conftest import SF

from credence.plans import loans as data
from credence.plans import reports


@pytest.fixture(scope="module")
def clean_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "loans")
    data.clean(spark, SF).write.partitionBy("issue_year").parquet(path)
    return path


EXPECTED = {
    "vintage": {"vintage_curve": 366, "vintage_summary": 6, "loans_per_issue_year": 6},
    "drift": {"psi_report": 16, "psi_status_summary": None},
    "evaluation": {"coefficients": 28, "ranking_quality": 1, "policy_comparison": 3,
                   "policy_delta": 1},
    "frontier": {"frontier": 25, "frontier_best": 2},
    "sensitivity": {"sensitivity": 15, "robustness": 3, "optimum_stability": 2},
    "parity": {"proxy_counts": 2, "parity_screen": 3},
}


@pytest.fixture(scope="module")
def model_path(tmp_path_factory):
    return str(tmp_path_factory.mktemp("model") / "pd")


@pytest.mark.parametrize("name", EXPECTED)
def test_report_tables(spark, clean_path, model_path, tmp_path, name):
    reports.main([name, "--clean", clean_path, "--out", str(tmp_path), "--model", model_path])
    for table, rows in EXPECTED[name].items():
        count = spark.read.parquet(str(tmp_path / table)).count()
        assert count == rows if rows else count > 0


def test_stored_model_keeps_its_medians_and_refuses_another_split(spark, clean_path, tmp_path):
    path = str(tmp_path / "pd")
    clean = spark.read.parquet(clean_path)
    first, again = reports.backtest(clean, path), reports.backtest(clean, path)
    assert first.test.agg({"pd": "sum"}).first() == again.test.agg({"pd": "sum"}).first()
    with pytest.raises(ValueError, match="is of split"):
        reports.backtest(clean, path, "2014-01-01")
    with pytest.raises(ValueError, match="another table"):
        reports.backtest(spark.read.parquet(clean_path + "/issue_year=2013").limit(0), path)


def test_ingest_then_sample(spark, raw_csv, tmp_path):
    clean, out = str(tmp_path / "clean"), str(tmp_path / "sample")
    reports.main(["ingest", "--raw", raw_csv, "--clean", clean, "--log", str(tmp_path / "log")])
    reports.main(["sample", "--clean", clean, "--out", out, "--rows", "10"])
    assert spark.read.parquet(out).count() == 4


def test_missing_arguments(clean_path):
    with pytest.raises(SystemExit):
        reports.main(["ingest", "--clean", clean_path])
