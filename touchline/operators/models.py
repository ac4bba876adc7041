"""Outcome classifiers on Spark ML, with and without class weights."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import HASH_RANGE, key_hash
from touchline.operators.evaluation import classification_report, metrics_document
from touchline.operators.features import class_weights, encode_target, weight_column
from touchline.operators.knn import kept, knn_predict
from touchline.operators.sampling import stratified_sample
from touchline.schema import KEY, LABELS, TARGET
from touchline.session import scratch_root

CLASS_NAMES = dict(enumerate(LABELS))
WEIGHT = "classWeight"


def prepare(df: DataFrame, features: list[str], weights=None, key: str = KEY) -> DataFrame:
    """(key, label, features[, classWeight]) rows for a learner. Features must be complete; a null is an error."""
    cols = [F.col(key), encode_target().cast("double").alias("label"),
            *[F.col(c).cast("double").alias(c) for c in features]]
    if weights is not None:
        cols.append(weights.alias(WEIGHT))
    rows = df.select(*cols)
    keep = [key, "label", "features"] + ([WEIGHT] if weights is not None else [])
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows).select(*keep)


def random_forest(weight_col: str | None = WEIGHT, trees: int = 200, depth: int = 10, min_leaf: int = 5, seed: int = 42):
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
                                   featureSubsetStrategy="sqrt", seed=seed)
    return model.setWeightCol(weight_col) if weight_col else model


def boosted_trees(weight_col: str | None = WEIGHT, rounds: int = 300, depth: int = 5, rate: float = 0.05,
                  rows: float = 0.8, columns: float = 0.8, seed: int = 42):
    """One boosted binary model per class."""
    tree = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
                         featureSubsetStrategy=str(columns), seed=seed)
    model = OneVsRest(classifier=tree, parallelism=3)
    return model.setWeightCol(weight_col) if weight_col else model


def neural_net(n_features: int, hidden=(256, 128, 64), classes: int = 3, max_iter: int = 100, seed: int = 42):
    """Sigmoid hidden layers and softmax output, trained by L-BFGS. Takes no weights: see ``balanced_rows``."""
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, classes], maxIter=max_iter, seed=seed)


def softmax_regression(weight_col: str | None = WEIGHT, max_iter: int = 100, reg: float = 0.0):
    model = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg)
    return model.setWeightCol(weight_col) if weight_col else model


def balanced_rows(prepared: DataFrame, key: str = KEY, seed: int = 42) -> DataFrame:
    """Rows repeated so that classes weigh the same: each floor(weight) times, and once more by key hash."""
    extra = (key_hash(key, f"balance{seed}") / float(HASH_RANGE) < F.col(WEIGHT) - F.floor(WEIGHT)).cast("int")
    times = (F.floor(WEIGHT) + extra).cast("int")
    return (prepared.withColumn("_n", times).filter("_n > 0")
                    .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n", "_i"))


def predict(model, prepared: DataFrame, key: str = KEY) -> DataFrame:
    return model.transform(prepared).select(key, F.col("label").cast("int").alias("label"),
                                            F.col("prediction").cast("int").alias("prediction"))


def training_history(model, spark) -> DataFrame:
    """Objective per iteration of a fitted softmax or neural-net model."""
    history = model.summary.objectiveHistory if hasattr(model.summary, "objectiveHistory") else model.summary().objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(history)], "iteration int, objective double")


def softmax_coefficients(model, features: list[str], spark) -> DataFrame:
    """Weights and intercept per class in long form."""
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(CLASS_NAMES[c], f, float(w[c, j])) for c in range(len(b)) for j, f in enumerate(features)]
    rows += [(CLASS_NAMES[c], "(intercept)", float(v)) for c, v in enumerate(b)]
    return spark.createDataFrame(rows, "class string, feature string, weight double")


@dataclass(frozen=True)
class Evaluation:
    predictions: DataFrame
    metrics: DataFrame


def knn_evaluate(train: DataFrame, test: DataFrame, features: list[str], label: str = "label", k: int = 8,
                 fraction: float | None = None, key: str = KEY, weights: str = "uniform") -> Evaluation:
    """Predict test rows (or a stratified part of them) and return predictions and a metrics row."""
    start = time.perf_counter()
    if fraction is not None:
        # Written: several jobs read it, and planning further columns on top of its plan overruns a driver's memory.
        test = kept(stratified_sample(test, fraction, by=label, strata=tuple(CLASS_NAMES), key=key), "knn-sample")
    found = knn_predict(train, test, features, label, k, key, weights)
    scratch_root(train.sparkSession)
    found = found.checkpoint()
    n_test = found.count()
    elapsed = time.perf_counter() - start
    rows = test.select(F.col(key).alias("query_id"), F.col(label).alias("label")).join(found, "query_id")
    metrics = metrics_document(classification_report(rows, CLASS_NAMES), k, train.count(), n_test, elapsed)
    return Evaluation(rows, metrics)


def softmax_evaluate(train: DataFrame, test: DataFrame, features: list[str], max_iter: int = 100) -> Evaluation:
    """Weighted softmax regression fitted on train rows and scored on test rows."""
    weights = weight_column(train)
    fit_rows, test_rows = prepare(train, features, weights), prepare(test, features, weights)
    start = time.perf_counter()
    model = softmax_regression(max_iter=max_iter).fit(fit_rows)
    elapsed = time.perf_counter() - start
    rows = predict(model, test_rows)
    n_train = int(class_weights(train).agg(F.sum("n")).first()[0])
    metrics = metrics_document(classification_report(rows, CLASS_NAMES), None, n_train, test_rows.count(), elapsed)
    return Evaluation(rows, metrics)
