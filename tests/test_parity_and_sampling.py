import hashlib

import pytest
from pyspark.sql import functions as F

from credence.operators import parity
from credence.operators.sampling import sample_rows


@pytest.fixture(scope="module")
def states(spark):
    rows = [(i, state) for i, state in enumerate(["CA", "TX", "NY", "OH", "ZZ"] * 200)]
    return spark.createDataFrame(rows, "loan_id int, addr_state string")


def draw(key, seed):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16) / 2**52


def test_probability_and_group(states):
    rows = parity.assign_proxy(states, seed=42).collect()
    table = {"CA": 0.35, "TX": 0.30, "NY": 0.32, "OH": 0.20, "ZZ": 0.20}
    for r in rows:
        assert r.geo_proxy_probability == table[r.addr_state]
        expected = "Group B" if draw(r.loan_id, 42) < table[r.addr_state] else "Group A"
        assert r.protected_class_proxy == expected


def test_seed_decides_and_partitioning_does_not(states):
    def groups(df, seed):
        return {r.loan_id: r[parity.GROUP] for r in parity.assign_proxy(df, seed).collect()}

    assert groups(states, 1) == groups(states.repartition(17), 1)
    assert groups(states, 1) != groups(states, 2)


def ratio(spark, a, b):
    return spark.range(1).select(parity.four_fifths_ratio(F.lit(a), F.lit(b))).first()[0]


def test_ratio(spark):
    assert ratio(spark, 0.5, 0.5) == 1.0
    assert ratio(spark, 0.4, 0.8) == ratio(spark, 0.8, 0.4) == 0.5
    assert ratio(spark, 0.0, 0.0) == 1.0
    assert ratio(spark, 0.5, 0.9) < 0.8


def test_screen(states):
    df = parity.assign_proxy(states)
    policies = {"even": F.col("loan_id") % 2 == 0, "only_a": F.col(parity.GROUP) == "Group A",
                "nobody": F.lit(False)}
    got = {r.policy: r for r in parity.parity_screen(df, policies).collect()}
    assert list(got) == list(policies)
    a = df.filter(F.col(parity.GROUP) == "Group A")
    assert got["even"].group_a_n == a.count()
    assert got["even"].group_a_approval_rate == pytest.approx(
        a.filter("loan_id % 2 = 0").count() / a.count())
    assert (got["only_a"].four_fifths_ratio, got["only_a"].flagged) == (0.0, True)
    assert (got["nobody"].four_fifths_ratio, got["nobody"].flagged) == (1.0, False)
    counts = {r[0]: r[1] for r in parity.proxy_counts(df).collect()}
    assert sum(counts.values()) == 1000


def test_empty_group_is_flagged(states):
    df = states.withColumn(parity.GROUP, F.lit("Group A"))
    got = parity.parity_screen(df, {"all": F.lit(True)}).first()
    assert (got.group_b_n, got.four_fifths_ratio, got.flagged) == (0, 0.0, True)


def test_sample_is_exact_and_keyed(states):
    expected = sorted(range(1000), key=lambda i: draw(i, 9))[:137]
    for df in (states, states.repartition(13)):
        got = sorted(r.loan_id for r in sample_rows(df, 137, seed=9).collect())
        assert got == sorted(expected)
    assert sample_rows(states, 5000).count() == 1000
    assert sample_rows(states, 0).count() == 0


def test_sample_with_equal_draws(spark):
    df = spark.createDataFrame([("same",)] * 10, "loan_id string")
    assert sample_rows(df, 4).count() == 4
