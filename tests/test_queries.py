import re

import pytest
from check_oracles import compare, connect
from conftest import SF

import __spark_entry__ as contract
from credence.plans.oracles import ORACLES
from credence.plans.registry import QUERIES

ROWS_ONLY = {"challenger_coefficients", "score_model", "ranking_quality_model",
             "policy_comparison_model", "frontier_model"}


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(
        contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name],
                   SF) == ""


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_queries_return_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_keeps_loans_spread(spark, name):
    """No Python rows, no cross joins, and one-task exchanges only above an aggregation."""
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = "\n".join(lines[i + 1:])
            assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|LocalLimit", below)


def test_scans_prune_columns_and_years(spark):
    text = plan(QUERIES["champion_fixed_cutoff"](spark, SF))
    assert "issue_year" in re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert len(schema.split(",")) <= 3
    assert "PushedFilters: [In(grade" in plan(QUERIES["filter_grade"](spark, SF))
