"""Binary logistic regression without penalty.

``fit_logistic`` is the ``pyspark.ml`` estimator in a pipeline: one model, to save and load.

``fit_logistic_models`` fits many models over the same rows at once, such as the folds of a
cross-validation or several feature sets. Each Newton step needs the sums w x x' and (y - p) x; all
models' sums come from one pass, so ten folds cost as many scans as one fit, and Newton needs
about seven scans where a gradient method needs tens per model.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-10
# The loss of a fit that separates the classes falls without end; below this share it is done.
SEPARATED = 1e-6


def fit_logistic(df: DataFrame, label: str, features: Sequence[str], max_iter: int = 200, tol: float = 1e-10) -> PipelineModel:
    """One model on a 0/1 label."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    estimator = LogisticRegression(featuresCol="features", labelCol=label, family="binomial", regParam=0.0, maxIter=max_iter, tol=tol)
    return Pipeline(stages=[assembler, estimator]).fit(df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``p`` (probability of 1) and ``pred`` (0/1)."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("p"), F.col("prediction").cast("int").alias("pred"))


@dataclass(frozen=True)
class LogisticModel:
    features: tuple[str, ...]
    coefs: tuple[float, ...]
    intercept: float
    converged: bool
    steps: int

    def logit(self) -> Column:
        value = F.lit(self.intercept)
        for name, b in zip(self.features, self.coefs):
            value = value + F.lit(b) * F.col(name)
        return value

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit()))

    def predicted(self) -> Column:
        return (self.logit() > 0).cast("int")


@dataclass(frozen=True)
class LogisticTask:
    """What to fit: feature columns, and the condition that marks the rows to fit on."""

    features: tuple[str, ...]
    rows: Column | None = None


class _Newton:
    """The state of one fit on shifted and scaled features."""

    def __init__(self, task: LogisticTask, shift: Mapping[str, float], scale: Mapping[str, float], max_steps: int):
        self.task = task
        self.max_steps = max_steps
        self.shift = np.array([shift[c] for c in task.features])
        self.scale = np.array([scale[c] for c in task.features])
        self.beta = np.zeros(len(task.features) + 1)
        self.step = np.zeros_like(self.beta)
        self.loss = np.inf
        self.first_loss = None
        self.steps = 0
        self.halvings = 0
        self.done = False
        self.converged = False

    def advance(self, rows: float, loss: float, gradient: np.ndarray, hessian: np.ndarray) -> None:
        """Take one step, given the sums at the current coefficients."""
        if rows == 0:
            raise ValueError("a model has no rows to fit on")
        if loss > self.loss * (1 + 1e-12) and self.halvings < 30:
            # The step went too far: take half of it back.
            self.step = self.step / 2
            self.beta = self.beta - self.step
            self.halvings += 1
            return
        self.loss, self.halvings = loss, 0
        self.first_loss = loss if self.first_loss is None else self.first_loss
        if loss <= SEPARATED * self.first_loss:
            self.done = True
            return
        self.step = np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
        self.steps += 1
        self.beta = self.beta + self.step
        if np.max(np.abs(self.step)) <= TOLERANCE * (1 + np.max(np.abs(self.beta))):
            self.done = self.converged = True
        elif self.steps >= self.max_steps:
            self.done = True

    def model(self) -> LogisticModel:
        coefs = self.beta[1:] / self.scale
        intercept = float(self.beta[0] - coefs @ self.shift)
        return LogisticModel(self.task.features, tuple(map(float, coefs)), intercept, self.converged, self.steps)


def fit_logistic_models(df: DataFrame, label: str, tasks: Mapping[str, LogisticTask], solver: str = "newton", max_steps: int = 40) -> dict[str, LogisticModel]:
    """Fit every task on its rows with a known label and no missing value among its own features.

    ``newton`` shares the scans of all tasks; its sums have features^2 numbers per task and model.
    ``estimator`` fits the models one by one and suits models of many hundreds of features. Where the classes
    can be separated there is no finite fit, and ``converged`` is false, as it is after ``max_steps``.
    """
    if solver == "newton":
        return _fit_together(df, label, tasks, max_steps)
    if solver == "estimator":
        return {name: _fit_by_estimator(df, label, t, max_steps) for name, t in tasks.items()}
    raise ValueError(f"unknown solver {solver!r}")


def _fit_by_estimator(df: DataFrame, label: str, task: LogisticTask, max_steps: int) -> LogisticModel:
    rows = df if task.rows is None else df.where(task.rows)
    # A step of L-BFGS does less than one of Newton's method.
    fitted = fit_logistic(rows.dropna(subset=[label, *task.features]), label, task.features, max_iter=5 * max_steps).stages[-1]
    steps = int(fitted.summary.totalIterations)
    return LogisticModel(task.features, tuple(map(float, fitted.coefficients)), float(fitted.intercept), steps < fitted.getMaxIter(), steps)


def _fit_together(df: DataFrame, label: str, tasks: Mapping[str, LogisticTask], max_steps: int) -> dict[str, LogisticModel]:
    """Newton's method for all tasks; the rows are narrowed to the columns in use and kept for the steps."""
    features = sorted({c for t in tasks.values() for c in t.features})
    marks = {f"r{m}": t.rows for m, t in enumerate(tasks.values()) if t.rows is not None}
    data = df.select(
        F.col(label).cast("double").alias("_y"),
        *[F.col(c).cast("double").alias(c) for c in features],
        *[c.alias(name) for name, c in marks.items()],
    ).dropna(subset=["_y"])
    data = data.persist()
    try:
        known = [F.when(~F.isnan(c), F.col(c)) for c in features]
        ends = data.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(known)], *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(known)]).first()
        shift = {c: (ends[f"m{i}"] or 0.0) for i, c in enumerate(features)}
        scale = {c: (ends[f"d{i}"] or 1.0) for i, c in enumerate(features)}
        fits = {name: _Newton(t, shift, scale, max_steps) for name, t in tasks.items()}
        while any(not f.done for f in fits.values()):
            waiting = [(m, f) for m, f in enumerate(fits.values()) if not f.done]
            for f, sums in zip((f for _, f in waiting), _step_sums(data, features, waiting, marks)):
                f.advance(*sums)
        return {name: f.model() for name, f in fits.items()}
    finally:
        data.unpersist()


def _step_sums(data: DataFrame, features: Sequence[str], waiting: list, marks: Mapping[str, Column]) -> list[tuple]:
    """Row count, loss, gradient and curvature of every waiting model, from one pass.

    Each task folds its Arrow batches with matrix products and returns one number per sum; those are
    added by an ordinary grouped aggregate. As generated code, the hundreds of sums would be
    compiled anew at every step, because the coefficients are part of it.
    """
    at = {c: i for i, c in enumerate(features)}
    specs = [
        (f"r{m}" if f"r{m}" in marks else None, [at[c] for c in f.task.features], f.shift, f.scale, f.beta) for m, f in waiting
    ]
    names = list(features)

    def fold(batches: Iterator) -> Iterator:
        held = None
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            y = batch.column("_y").to_numpy(zero_copy_only=False)
            parts = []
            for mark, columns, shift, scale, beta in specs:
                inside = ~np.isnan(x[:, columns]).any(axis=1)  # a null is read as NaN
                if mark is not None:
                    inside &= batch.column(mark).fill_null(False).to_numpy(zero_copy_only=False)
                rows, truth = (x[inside][:, columns] - shift) / scale, y[inside]
                rows = np.hstack([np.ones((len(rows), 1)), rows])
                z = rows @ beta
                # log(1 + e^z) - y z and 1 / (1 + e^-z), written so that neither sign of z overflows.
                small = np.exp(-np.abs(z))
                loss = np.maximum(z, 0.0) + np.log1p(small) - truth * z
                p = np.where(z >= 0, 1.0, small) / (1.0 + small)
                hessian = rows.T @ (rows * (p * (1.0 - p))[:, None])
                parts += [[float(len(rows)), loss.sum()], rows.T @ (truth - p), hessian.ravel()]
            sums = np.concatenate(parts)
            held = sums if held is None else held + sums
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held)], names=["i", "v"])

    collected = data.mapInArrow(fold, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros(sum(2 + len(f.beta) * (len(f.beta) + 1) for _, f in waiting))
    for row in collected:
        sums[row["i"]] = row["v"]
    results, start = [], 0
    for _, f in waiting:
        d = len(f.beta)
        part = sums[start : start + 2 + d * (d + 1)]
        results.append((part[0], part[1], part[2 : 2 + d], part[2 + d :].reshape(d, d)))
        start += len(part)
    return results
