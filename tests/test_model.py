import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from credence.fixed_values import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from credence.operators import pd_model
from credence.operators.ranking import ranking_quality


@pytest.fixture(scope="module")
def model(split):
    return pd_model.train_challenger(split[0])


def newton(train: pd.DataFrame):
    """Optimum of summed log loss plus half the squared weights, intercept free."""
    x = train[NUMERIC_FEATURES].to_numpy(float)
    x = (x - x.mean(0)) / x.std(0)
    dummies = [(c, v) for c in CATEGORICAL_FEATURES for v in sorted(train[c].unique())]
    onehot = np.column_stack([(train[c] == v).to_numpy(float) for c, v in dummies])
    x = np.column_stack([np.ones(len(x)), x, onehot])
    y, w = train["defaulted"].to_numpy(float), np.zeros(x.shape[1])
    penalty = np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (p - y) + penalty @ w)
    return w


def test_weights_match_newton(split, model):
    train = split[0].select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, "defaulted").toPandas()
    rows = pd_model.coefficients(model, split[0]).collect()
    assert [r.feature for r in rows][:2] == ["intercept", "fico_avg"]
    assert [r.weight for r in rows] == pytest.approx(list(newton(train)), abs=1e-6)


def test_expression_equals_pipeline(split, model):
    test = split[1].drop("pd")
    scored = pd_model.predict_pd(model, test).withColumn("again", pd_model.pd_expression(model))
    assert scored.filter(F.abs(F.col("pd") - F.col("again")) > 1.1e-9).isEmpty()
    assert scored.count() == test.count()


def test_unseen_category_counts_as_none(split, model):
    odd = split[1].drop("pd").withColumn("purpose", F.lit("never seen"))
    scored = pd_model.predict_pd(model, odd).withColumn("again", pd_model.pd_expression(model))
    assert scored.filter("pd is null or abs(pd - again) > 1.1e-9").isEmpty()


def test_model_ranks_better_than_chance_on_train(split, model):
    scored = split[0].withColumn("pd", pd_model.pd_expression(model))
    assert ranking_quality(scored).first().auc > 0.6


def test_model_survives_storage(split, model, tmp_path):
    from pyspark.ml import PipelineModel
    path = str(tmp_path / "model")
    model.write().save(path)
    again = pd_model.coefficients(PipelineModel.load(path), split[0]).collect()
    assert again == pd_model.coefficients(model, split[0]).collect()


def test_training_reads_small_splits(spark, split, tmp_path):
    """A task of the solver holds a bounded part of the training file; the session's splits stay."""
    split[0].repartition(1).write.parquet(str(tmp_path / "train"))
    name, seen = "spark.sql.files.maxPartitionBytes", []
    before, fit = spark.conf.get(name), pd_model.Pipeline.fit
    pd_model.Pipeline.fit = lambda self, rows: seen.append(spark.conf.get(name)) or fit(self, rows)
    try:
        pd_model.train_challenger(spark.read.parquet(str(tmp_path / "train")))
    finally:
        pd_model.Pipeline.fit = fit
    assert seen == [pd_model.TRAIN_SPLIT] and spark.conf.get(name) == before
