"""One key holds a third of the rows: results stay whole and no task gets the hot group alone."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from credence.operators import cleaning, drift, policies, vintage
from credence.operators.ranking import ranking_quality
from credence.sources.loan_tape import raw_loans


@pytest.fixture
def skewed(spark, tmp_path):
    """The small tables with a third of lineitem on one order and of orders on one customer."""
    for table, key in (("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("customer", None)):
        df = spark.read.parquet(f"{SF}/{table}.parquet")
        if key:
            order = F.col("l_orderkey") if table == "lineitem" else F.col("o_orderkey")
            hot = (F.xxhash64(*df.columns) % 3 == 0) if table == "lineitem" else (order % 3 == 0)
            df = df.withColumn(key, F.when(hot, F.lit(7).cast("long")).otherwise(F.col(key)))
        df.repartition(8).write.parquet(str(tmp_path / f"{table}.parquet"))
    return str(tmp_path)


def test_hot_order_is_split(spark, skewed):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet")
    expected = lines.count() + lines.filter("l_orderkey % 50 = 0").count()
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        raw = raw_loans(spark, skewed)
        assert len(raw.collect()) == expected
        assert "skew=true" in raw._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_copies_collapse_before_the_shuffle(spark, skewed):
    raw = raw_loans(spark, skewed)
    one = raw.limit(1).collect()
    copies = spark.createDataFrame(one * 3000, raw.schema)
    both = raw.unionByName(copies)
    assert cleaning.deduped(both).count() == cleaning.deduped(raw).count()
    text = cleaning.deduped(both)._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") >= 2


def test_hot_values_in_every_report(spark, loans, loans_pdf):
    hot = loans.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(
        F.col("loan_id") == "N-007", 150).otherwise(1)))).withColumn(
        "loan_id", F.concat_ws("-", "loan_id", "copy"))
    pdf = loans_pdf.loc[loans_pdf.index.repeat(np.where(loans_pdf.loan_id == "N-007", 150, 1))]
    fico, pd = policies.calibrate(hot, [0.3, 0.6, 0.85])
    assert fico == pytest.approx(list(pdf.fico_avg.quantile([0.7, 0.4, 1 - 0.85])))
    assert pd == pytest.approx(list(pdf.pd.quantile([0.3, 0.6, 0.85])))
    sizes = {r.issue_year: r.vintage_size for r in vintage.vintage_summary(hot).collect()}
    assert sizes == pdf.issue_d.str[-4:].astype(int).value_counts().to_dict()
    bad, good = (pdf.pd[pdf.defaulted == y].to_numpy() for y in (1, 0))
    auc = ((bad[:, None] > good).sum() + (bad[:, None] == good).sum() / 2) / bad.size / good.size
    assert ranking_quality(hot).first().auc == pytest.approx(auc)
    assert drift.psi_report(hot, hot, ["fico_avg", "pd"], ["purpose"]).agg(
        F.max("psi")).first()[0] == 0.0
