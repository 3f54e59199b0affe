"""Multilayer perceptrons on array columns.

The estimator is the one of ``pyspark.ml``: gradients are summed over the cluster and the weights
are one vector on the driver. Its hidden units are sigmoid and its solver is L-BFGS, so training
goes on in stages that start from the weights of the stage before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentloom.functions import arrays
from momentloom.operators import metrics


def parameter_count(layers: Sequence[int]) -> int:
    """Weights and biases of a chain of fully connected layers."""
    return sum((a + 1) * b for a, b in zip(layers, layers[1:]))


def training_rows(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.select(array_to_vector(arrays.doubles(features)).alias("features"), F.col(label).cast("double").alias("label"))


def fit_mlp(
    rows: DataFrame, layers: Sequence[int], max_iter: int, seed: int = 1, block_size: int = 512, weights=None
) -> MultilayerPerceptronClassificationModel:
    """Train on ``training_rows``; with ``weights`` training goes on from there."""
    estimator = MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, seed=seed, blockSize=block_size, tol=1e-9)
    if weights is not None:
        estimator = estimator.setInitialWeights(weights)
    return estimator.fit(rows)


def score_mlp(model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str) -> DataFrame:
    """Add ``probs`` (array) and ``pred`` (class index)."""
    scored = model.transform(df.withColumn("features", array_to_vector(arrays.doubles(features))))
    return scored.select(*df.columns, vector_to_array("probability").alias("probs"), F.col("prediction").cast("int").alias("pred"))


@dataclass(frozen=True)
class Quality:
    loss: float
    accuracy: float
    balanced_accuracy: float


def quality(model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str, label: str) -> Quality:
    """Loss, accuracy and balanced accuracy from one grouped pass: one row per class returns."""
    scored = score_mlp(model, df.select(features, label), features)
    p_true = F.element_at("probs", F.col(label).cast("int") + 1)
    rows = scored.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("pred") == F.col(label)).alias("hits"),
        F.sum(metrics.probability_loss(p_true)).alias("loss"),
    ).collect()
    if not rows:
        raise ValueError("there are no rows to score")
    size = sum(r["n"] for r in rows)
    return Quality(
        sum(r["loss"] for r in rows) / size,
        sum(r["hits"] for r in rows) / size,
        sum(r["hits"] / r["n"] for r in rows) / len(rows),
    )


def batch_balanced(model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str, label: str, batch: str) -> float | None:
    """Mean over the batches of their balanced accuracies."""
    scored = score_mlp(model, df.select(features, label, batch), features)
    return metrics.mean_batch_balanced_accuracy(scored, batch, label, "pred").first()["balanced_accuracy"]


def staged_fits(train: DataFrame, features: str, label: str, layers: Sequence[int], epochs: int, steps: int, seed: int = 1, persist: bool = True):
    """Yield ``(epoch, model)`` after every ``steps`` solver iterations, each from the last weights.

    ``persist`` keeps the training rows for the epochs; it is not needed where the caller keeps the table.
    """
    rows = training_rows(train, features, label)
    if persist:
        rows = rows.persist()
    try:
        weights = None
        for epoch in range(1, epochs + 1):
            model = fit_mlp(rows, layers, steps, seed, weights=weights)
            weights = model.weights
            yield epoch, model
    finally:
        if persist:
            rows.unpersist()
