"""Estimators of ``pyspark.ml`` put together as the queries use them, results as tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators import metrics
from plainloom.session import stage


@contextmanager
def reused(df: DataFrame):
    """Keep a table in memory or on disk while iterative fits read it again and again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def fit(estimator: Estimator, df: DataFrame, columns: Sequence[str] = ()) -> Model:
    """Fit on ``df``, kept meanwhile; only the named columns, if any are, are kept."""
    with reused(df.select(*columns) if columns else df) as data:
        return estimator.fit(data)


def stored_values(vector: str) -> Column:
    """The entries a vector stores: all of a dense one, the non-zero ones of a sparse one."""
    return F.unwrap_udt(F.col(vector))["values"]


def nonzero_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has at least one entry other than zero; sparse vectors stay sparse."""
    return df.where(F.exists(stored_values(vector), lambda x: x != 0))


def bernoulli_bayes(features: str = "features", label: str = "label") -> Estimator:
    """Bernoulli naive Bayes over features thresholded at 0."""
    return Pipeline(
        stages=[
            Binarizer(threshold=0.0, inputCol=features, outputCol="_bits"),
            NaiveBayes(featuresCol="_bits", labelCol=label, modelType="bernoulli"),
        ]
    )


def bagged_trees(n: int = 10, seed: int = 1, **columns) -> Estimator:
    """Bootstrap trees that all see every feature."""
    return RandomForestClassifier(
        numTrees=n, featureSubsetStrategy="all", subsamplingRate=1.0, seed=seed, **columns
    )


def boosted_trees(classes: int = 2, label: str = "label", **params) -> Estimator:
    """Gradient-boosted trees; beyond two classes one against the rest."""
    trees = GBTClassifier(labelCol=label, **params)
    return trees if classes == 2 else OneVsRest(classifier=trees, labelCol=label, parallelism=4)


def linear_svm(label: str = "label", **params) -> Estimator:
    """Linear SVM for any number of classes, one against the rest."""
    return OneVsRest(classifier=LinearSVC(labelCol=label, **params), labelCol=label, parallelism=4)


def linear_regression(label: str, features: str = "features") -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal", regParam=0.0)


def ridge(df: DataFrame, label: str, alpha: float, features: str = "features") -> LinearRegressionModel:
    """Least squares with penalty alpha * |b|^2 on the sum of squared errors.

    Spark divides the error by n and scales the label, hence alpha / n * std(y).
    """
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LinearRegression(
        featuresCol=features, labelCol=label, solver="normal", standardization=False,
        regParam=alpha / row["n"] * row["s"], elasticNetParam=0.0,
    ).fit(df)


def lasso(df: DataFrame, label: str, alpha: float, features: str = "features") -> LinearRegressionModel:
    """Least squares with penalty alpha * |b| on half the mean squared error."""
    return LinearRegression(
        featuresCol=features, labelCol=label, solver="normal", standardization=False,
        regParam=alpha, elasticNetParam=1.0, tol=1e-10, maxIter=500,
    ).fit(df)


def coefficient_table(model: LinearRegressionModel, names: Sequence[str], like: DataFrame) -> DataFrame:
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return like.sparkSession.createDataFrame(rows, "term string, coefficient double")


def importance_table(model: Model, names: Sequence[str], like: DataFrame) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    table = like.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


class AdaBoost:
    """Two-class boosting of shallow trees: each round weights the rows the last one missed."""

    def __init__(
        self, rounds: int = 10, depth: int = 1, label: str = "label", seed: int = 1, stage_every: int = 5, bins: int = 32
    ):
        self.rounds, self.depth, self.label, self.seed, self.bins = rounds, depth, label, seed, bins
        self.stage_every = stage_every
        self.trees: list[tuple[float, Model]] = []

    def fit(self, df: DataFrame) -> AdaBoost:
        self.trees = []
        data = df.withColumn("_w", F.lit(1.0))
        for i in range(self.rounds):
            tree = DecisionTreeClassifier(
                labelCol=self.label, weightCol="_w", maxDepth=self.depth, maxBins=self.bins, seed=self.seed,
                predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob",
            ).fit(data)
            scored = tree.transform(data).drop("_raw", "_prob")
            missed = (F.col("_p") != F.col(self.label)).cast("double")
            row = scored.agg(F.sum("_w").alias("all"), F.sum(F.col("_w") * missed).alias("bad"), F.count(F.lit(1)).alias("n")).first()
            error = row["bad"] / row["all"]
            if error >= 0.5:
                break
            alpha = math.log((1 - error) / max(error, 1e-10))
            self.trees.append((alpha, tree))
            if error == 0:
                break
            # scaled so that the mean weight stays 1
            total = row["all"] + row["bad"] * (math.exp(alpha) - 1)
            data = scored.withColumn("_w", F.col("_w") * F.exp(missed * alpha) * (row["n"] / total)).drop("_p")
            if (i + 1) % self.stage_every == 0:
                data = stage(data)  # rounds would otherwise stack up in one plan
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out, vote = df, F.lit(0.0)
        for i, (alpha, tree) in enumerate(self.trees):
            tree.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
            out = tree.transform(out)
            vote = vote + F.when(F.col(f"_p{i}") == 1, alpha).otherwise(-alpha)
        scored = out.withColumn("score", vote).select(*df.columns, "score")
        return scored.withColumn("prediction", (F.col("score") > 0).cast("double"))


def classification_scores(predictions: DataFrame, label: str, name: str) -> DataFrame:
    """One row: model, accuracy, rows, share of the most frequent class."""
    biggest = predictions.groupBy(label).count().agg(F.max("count")).scalar()
    scores = metrics.accuracy(predictions, label, "prediction")
    return scores.select(F.lit(name).alias("model"), "accuracy", "n", (biggest / F.col("n")).alias("majority"))


def compare_classifiers(
    estimators: Mapping[str, Estimator], train: DataFrame, test: DataFrame, label: str = "label"
) -> DataFrame:
    """Fit every estimator on the same rows and score it on the same rows; best first."""
    with reused(train) as data:
        fitted = {name: e.fit(data) for name, e in estimators.items()}
    rows = None
    for name, model in fitted.items():
        scores = classification_scores(model.transform(test), label, name)
        rows = scores if rows is None else rows.unionByName(scores)
    return rows.orderBy(F.col("accuracy").desc(), "model")


def compare_reports(
    estimators: Mapping[str, Estimator], train: DataFrame, test: DataFrame, label: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """Per model a report of its classes, and its confusion of classes, all on the same rows."""
    with reused(train) as data:
        fitted = {name: e.fit(data) for name, e in estimators.items()}
    reports, cells = [], []
    for name, model in fitted.items():
        scored = stage(model.transform(test).select(label, "prediction"))
        reports.append(metrics.class_report(scored, label, "prediction").select(F.lit(name).alias("model"), "*"))
        cells.append(metrics.confusion(scored, label, "prediction").select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, reports), reduce(DataFrame.unionByName, cells)


def compare_regressors(
    estimators: Mapping[str, Estimator], train: DataFrame, test: DataFrame, label: str
) -> DataFrame:
    with reused(train) as data:
        fitted = {name: e.fit(data) for name, e in estimators.items()}
    rows = None
    for name, model in fitted.items():
        scores = metrics.regression_metrics(model.transform(test), label, "prediction")
        scores = scores.select(F.lit(name).alias("model"), "*")
        rows = scores if rows is None else rows.unionByName(scores)
    return rows.orderBy(F.col("r2").desc(), "model")


def submission(model: Model, df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, integer prediction) for rows without a label."""
    return model.transform(df).select(key, F.col("prediction").cast("long").alias(name))
