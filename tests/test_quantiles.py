import sys
import uuid

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credence.operators import quantiles
from credence.operators.quantiles import exact_quantiles, value_at_rank

SHARES = [0.0, 0.05, 1 - 0.85, 0.333, 0.5, 0.77, 0.99, 1.0]


def frame(spark, **columns):
    names = list(columns)
    rows = list(zip(*[[None if v is None else float(v) for v in columns[n]] for n in names]))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def test_matches_numpy_on_mixed_columns(spark):
    rng = np.random.default_rng(7)
    n = 3000
    hot = np.where(rng.random(n) < 0.4, 12.5, rng.lognormal(3, 4, n))
    columns = {"smooth": rng.normal(0, 1, n), "hot": hot, "counts": rng.integers(0, 5, n),
               "same": np.full(n, 3.25), "near": 1 + rng.integers(0, 50, n) * 2.0**-52}
    found = exact_quantiles(frame(spark, **columns), {c: SHARES for c in columns})
    for name, values in columns.items():
        assert found[name] == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-15)
    spread = exact_quantiles(frame(spark, **columns).repartition(17), {c: SHARES for c in columns})
    assert spread == found


def test_nulls_empty_and_wrong_bounds(spark):
    df = frame(spark, a=[5, None, 1, None, 9], b=[None] * 5)
    assert exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [5.0], "b": [None]}
    assert exact_quantiles(df, {"a": [0.0, 0.5, 1.0]}, {"a": (4.0, 6.0)})["a"] == [1, 5, 9]


def test_extreme_values(spark):
    tiny = 5e-324
    df = frame(spark, wild=[1.0, 2.0, float("nan"), float("inf"), -1.7e308, 3.0, 1.7e308],
               close=[tiny, 0.0, 2 * tiny, 0.0, tiny, tiny, 3 * tiny])
    found = exact_quantiles(df, {"wild": [0.0, 0.4, 0.6], "close": [0.0, 0.5, 1.0]})
    assert found == {"wild": [-1.7e308, 2.0, 3.0], "close": [0.0, tiny, 3 * tiny]}
    assert value_at_rank(df, "wild", 5)[0] == sys.float_info.max


def test_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FIRST_SLICES", 4)
    monkeypatch.setattr(quantiles, "NEXT_SLICES", 3)
    values = np.random.default_rng(1).exponential(1e6, 400)
    found = exact_quantiles(frame(spark, x=values), {"x": SHARES})["x"]
    assert found == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-15)


def test_input_is_read_twice_whatever_the_values(spark, tmp_path, monkeypatch):
    """Every pass over the rows leaves a mark: one for the sketch, one for the brackets."""
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.lognormal(0, 9, 4000), np.full(3000, 7.0),
                             1 + rng.integers(0, 99, 2000) * 2.0**-52])
    df = frame(spark, x=values, y=-values).coalesce(1)

    def marked(batches):
        (tmp_path / uuid.uuid4().hex).touch()
        yield from batches

    found = exact_quantiles(df.mapInArrow(marked, df.schema), {"x": SHARES, "y": [0.5]})
    assert found["x"] == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-15)
    assert found["y"] == [pytest.approx(-np.quantile(values, 0.5), rel=1e-15)]
    assert len(list(tmp_path.iterdir())) == 2


def test_brackets_that_miss_give_way_to_the_rounds(spark, monkeypatch):
    values = np.random.default_rng(3).normal(0, 1, 5000)
    monkeypatch.setattr(quantiles, "_brackets", lambda spark, sketches, ranks: {
        n: [(-9.0, -8.0), (0.5, 0.6)] for n in sketches})
    found = exact_quantiles(frame(spark, x=values, y=values), {"x": SHARES, "y": [0.7]})
    assert found["x"] == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-15)
    assert found["y"] == [pytest.approx(np.quantile(values, 0.7), rel=1e-15)]


def test_brackets_are_narrow_and_hold_their_ranks(spark):
    n = 60_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("x"))
    row = quantiles._sketched(df, ["x"])
    facts = {"x": tuple(row[f"{k}0"] for k in ("n", "min", "max", "sketch"))}
    ranks = {0, n // 4, n // 2, n - 1}
    ranges = quantiles._brackets(spark, facts, {"x": ranks})["x"]
    values = sorted(r.x for r in df.collect())
    assert all(any(a <= values[r] <= b for a, b in ranges) for r in ranks)
    assert sum(sum(a <= v <= b for v in values) for a, b in ranges) < n * 0.06


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e12, 1e12, allow_subnormal=False), min_size=1, max_size=40),
       share=st.floats(0, 1))
def test_any_numbers(spark, values, share):
    found = exact_quantiles(frame(spark, x=values), {"x": [share]})["x"][0]
    assert found == pytest.approx(float(np.quantile(values, share)), rel=1e-12, abs=1e-12)


def test_value_at_rank_counts_rows_below(spark):
    df = frame(spark, x=[3, 1, 2, 2, 2, 7])
    assert value_at_rank(df, "x", 0) == (1.0, 0)
    assert value_at_rank(df, "x", 3) == (2.0, 1)
    assert value_at_rank(df, "x", 5, (0.0, 1.0)) == (7.0, 5)
