"""The challenger's probability-of-default model: scaled numbers, one-hot categories, logistic
regression with the default penalty (C = 1, intercept free)."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.fixed_values import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from credence.functions.scoring import fitted_score, on_grid
from credence.session import settings

#: Most of a file that one task of the training reads.
TRAIN_SPLIT = "16m"


def challenger_pipeline(train_rows: int) -> Pipeline:
    """Unfitted pipeline for a training set of ``train_rows`` loans.

    The scaler divides by the sample deviation; the product step turns that into the population
    deviation. The mean loss plus an L2 weight of 1/n has the same optimum as the summed loss at
    C = 1. A category not seen in training becomes all zeros.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}_onehot" for c in CATEGORICAL_FEATURES]
    to_population = math.sqrt(train_rows / (train_rows - 1)) if train_rows > 1 else 1.0
    return Pipeline(stages=[
        StringIndexer(inputCols=CATEGORICAL_FEATURES, outputCols=indexed,
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(inputCol="sample_scaled", outputCol="scaled",
                           scalingVec=Vectors.dense([to_population] * len(NUMERIC_FEATURES))),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=TARGET, regParam=1.0 / train_rows,
                           elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-10),
    ])


def train_challenger(train: DataFrame) -> PipelineModel:
    """The solver keeps a task's rows as vectors, larger than in their files, and reads them in each
    of its steps; small splits bound what one task holds and reads."""
    rows = train.select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET)
    with settings(train.sparkSession, {"spark.sql.files.maxPartitionBytes": TRAIN_SPLIT}):
        return challenger_pipeline(rows.count()).fit(rows)


def predict_pd(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``pd`` by running the fitted pipeline."""
    scored = model.transform(df)
    return scored.withColumn("pd", on_grid(vector_to_array("probability")[1])).select(
        *df.columns, "pd")


def _parts(model: PipelineModel):
    indexer, _, _, scaler, product, _, regression = model.stages
    weights = list(regression.coefficients)
    to_population = product.getScalingVec()
    numeric = {name: (float(scaler.mean[i]), float(scaler.std[i] / to_population[i]),
                      float(weights[i])) for i, name in enumerate(NUMERIC_FEATURES)}
    pairs = [(column, label) for column, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray)
             for label in labels]
    match = {pair: float(w) for pair, w in zip(pairs, weights[len(NUMERIC_FEATURES):])}
    return float(regression.intercept), numeric, match


def pd_expression(model: PipelineModel) -> Column:
    """The fitted model as one column expression: same scores, no vectors per row."""
    return fitted_score(*_parts(model))


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, category, mean, deviation, weight); the intercept has its own row."""
    intercept, numeric, match = _parts(model)
    rows = [("intercept", None, None, None, intercept)]
    rows += [(name, None, mean, deviation, weight)
             for name, (mean, deviation, weight) in numeric.items()]
    rows += [(name, value, None, None, weight) for (name, value), weight in match.items()]
    return df.sparkSession.createDataFrame(
        rows, "feature string, category string, mean double, deviation double, weight double")


def explained_defaults(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """(feature, category, loans, explained) of scored training loans, in one pass.

    ``explained`` is what scores and penalty make of the defaults' mean product with the feature. At
    the optimum the gradient is zero and both are equal, for every weight; that is how a check
    without a solver can tell a fitted model. Categories are those the model knows.
    """
    _, numeric, match = _parts(model)
    rows, pd = F.count(F.lit(1)), F.col("pd")
    parts = [("intercept", None, rows, F.sum(pd))]
    parts += [(name, None, F.count(name),
               F.sum(pd * (F.col(name) - mean) / (deviation or 1.0)) + weight)
              for name, (mean, deviation, weight) in numeric.items()]
    parts += [(name, value, F.count_if(F.col(name) == value),
               F.coalesce(F.sum(F.when(F.col(name) == value, pd)), F.lit(0.0)) + weight)
              for (name, value), weight in match.items()]
    return scored.agg(F.array(*[F.struct(
        F.lit(name).alias("feature"), F.lit(value).cast("string").alias("category"),
        loans.alias("loans"), (total / rows).alias("explained"))
        for name, value, loans, total in parts]).alias("parts")).select(F.inline("parts"))
