"""Evaluating classifiers: cross-validation, feature sets, schemes, ensembles, learning logs."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.functions import arrays
from momentloom.functions.scalars import round_digits
from momentloom.operators import linear, metrics, neural, ordered, splits
from momentloom.operators.logistic import LogisticTask, fit_logistic_models
from momentloom.sources import store

PARALLEL_FITS = 8


def cv_accuracy(df: DataFrame, label: str, features: Sequence[str], fold: str, folds: int) -> DataFrame:
    """Held-out accuracy of a logistic classifier in each fold, with the rows scored and not scored.

    All folds are fitted together on shared scans. Each row is then scored by the model that has
    not seen it, in one pass.
    """
    tasks = {str(f): LogisticTask(tuple(features), F.col(fold) != f) for f in range(folds)}
    models = fit_logistic_models(df.select(label, fold, *features), label, tasks)
    predicted = F.lit(None).cast("int")
    for f in range(folds):
        predicted = F.when(F.col(fold) == f, models[str(f)].predicted()).otherwise(predicted)
    scored = df.select(fold, label, predicted.alias("pred"))
    return scored.groupBy(fold).agg(*_scored(label, "pred"), metrics.accuracy(label, "pred").alias("accuracy"))


def _scored(label: Column | str, pred: Column | str) -> list[Column]:
    """The number of rows with truth and prediction, and of those without."""
    missing = metrics.not_scored(label, pred)
    return [(F.count(F.lit(1)) - missing).alias("n"), missing.alias("n_not_scored")]


def mean_accuracy(folds: DataFrame, digits: int = 4) -> DataFrame:
    """The mean over the folds of ``cv_accuracy``."""
    return folds.agg(F.count("accuracy").alias("n_folds"), round_digits(F.avg("accuracy"), digits).alias("mean_accuracy"))


def compare_feature_sets(df: DataFrame, label: str, sets: Mapping[str, Sequence[str]], split: str = "split") -> DataFrame:
    """Train one logistic classifier per feature set on the train rows; accuracy on the test rows."""
    train = F.col(split) == "train"
    tasks = {name: LogisticTask(tuple(xs), train) for name, xs in sets.items()}
    used = list(dict.fromkeys(x for xs in sets.values() for x in xs))
    models = fit_logistic_models(df.select(label, split, *used), label, tasks)
    scored = df.where(F.col(split) == "test").select(F.col(label).alias("_y"), *[models[name].predicted().alias(f"_p{i}") for i, name in enumerate(sets)])
    made = []
    for i in range(len(sets)):
        n, missing = _scored("_y", f"_p{i}")
        made += [n.alias(f"n{i}"), missing.alias(f"m{i}"), metrics.accuracy("_y", f"_p{i}").alias(f"a{i}")]
    row = scored.agg(*made)
    each = [
        F.struct(
            F.lit(name).alias("feature_set"), F.lit(len(xs)).alias("n_features"),
            F.col(f"n{i}").alias("n_test"), F.col(f"m{i}").alias("n_not_scored"), F.col(f"a{i}").alias("accuracy"),
        )
        for i, (name, xs) in enumerate(sets.items())
    ]
    return row.select(F.inline(F.array(*each)))


def compare_raw_and_components(df: DataFrame, label: str, features: Sequence[str], split: str = "split", variance_ratio: float = 1.0) -> DataFrame:
    """The same classifier on the features and on their principal components.

    Standardising and components are fitted on the train rows only.
    """
    fitted = linear.pca_fit(df.where(F.col(split) == "train"), features, variance_ratio)
    both = fitted.transform(df, keep=[label, split, *features])
    made = [c for c in both.columns if c not in df.columns]
    return compare_feature_sets(both, label, {"original": list(features), "components": made}, split)


def ensemble_eval(df: DataFrame, label: str, members: Mapping[str, Column], classes: Sequence) -> DataFrame:
    """Balanced accuracy of each member and of their averaged probabilities.

    One pass: per class the hits of every member are counted side by side.
    """
    at = {name: f"_m{i}" for i, name in enumerate(members)}
    # Projected first: each member's scores are used twice below and computed once.
    scored = df.select(F.col(label).alias("_y"), *[p.alias(at[name]) for name, p in members.items()])
    picked = {name: metrics.most_probable(c, classes) for name, c in at.items()}
    picked["ensemble"] = metrics.most_probable(metrics.member_mean(list(at.values()), len(classes)), classes)
    hits = scored.select("_y", *[(c == F.col("_y")).cast("double").alias(name) for name, c in picked.items()])
    recalls = hits.where(F.col("_y").isNotNull()).groupBy("_y").agg(*[F.avg(name).alias(name) for name in picked])
    means = recalls.agg(*[F.avg(name).alias(name) for name in picked])
    each = [F.struct(F.lit(name).alias("member"), F.col(name).alias("balanced_accuracy")) for name in picked]
    return means.select(F.inline(F.array(*each)))


LOG_SCHEMA = "epoch int, loss double, accuracy double, test_loss double, test_accuracy double"


def learning_log(
    train: DataFrame, test: DataFrame, features: str, label: str, layers: Sequence[int], epochs: int, steps: int, seed: int = 1, every: int = 1
) -> list[dict]:
    """Loss and accuracy on both parts after each ``every``-th epoch of ``steps`` iterations."""
    log = []
    for epoch, model in neural.staged_fits(train, features, label, layers, epochs, steps, seed):
        if (epoch - 1) % every == 0:
            seen = neural.quality(model, train, features, label)
            held = neural.quality(model, test, features, label)
            log.append({"epoch": epoch, "loss": seen.loss, "accuracy": seen.accuracy, "test_loss": held.loss, "test_accuracy": held.accuracy})
    return log


EXPERIMENT_SCHEMA = (
    "approach string, model string, split int, epoch int, train_accuracy double, train_balanced_accuracy double, "
    "accuracy double, balanced_accuracy double, batch_balanced_accuracy double, seconds double"
)


def scheme_parts(approach: str, split: int, index: str, n: int, k: int) -> tuple[Column, Column]:
    """The conditions for the training and validation rows of one split."""
    if approach == "IndependentCV":
        block = splits.contiguous_block(index, n, k)
        return block == split - 1, block == split % k
    if approach == "StandardCV":
        tested = splits.standard_test_block(index, n, k)
        return tested != split, tested == split
    raise ValueError(f"unknown approach {approach!r}")


def cv_experiment(
    indexed: DataFrame,
    features: str,
    label: str,
    models: Mapping[str, Sequence[int]],
    n: int,
    k: int,
    epochs: int,
    steps: int,
    approaches: Sequence[str] = ("StandardCV", "IndependentCV"),
    index: str = "row_id",
    seed: int = 1,
    parallel: int = PARALLEL_FITS,
    batch: int = 64,
    start: float = 10.0,
    store_folder: str | None = None,
) -> DataFrame:
    """Scores on both parts after each epoch, in percent, for every scheme, model and split.

    A split is a filter on the row index, so the rows are kept once for all cells, and no cell keeps a copy. Every
    cell is a distributed fit; a few run side by side so that small jobs do not leave executors idle.
    With ``store_folder`` the model of each cell's best epoch above ``start`` is saved under ``member_path``.
    """
    data = indexed.select(index, features, label, ordered.batch_number(index, batch).alias("_batch")).persist()

    def run(cell: tuple[str, str, int]) -> list[tuple]:
        approach, name, split = cell
        in_train, in_val = scheme_parts(approach, split, index, n, k)
        begin, rows, bar = time.perf_counter(), [], start
        train, val = data.where(in_train), data.where(in_val)
        for epoch, model in neural.staged_fits(train, features, label, models[name], epochs, steps, seed, persist=False):
            seen, held = neural.quality(model, train, features, label), neural.quality(model, val, features, label)
            by_batch = neural.batch_balanced(model, val, features, label, "_batch")
            if 100 * held.accuracy > bar:
                bar = 100 * held.accuracy
                if store_folder:
                    store.save_model(model, member_path(store_folder, approach, name, split))
            scores = [100 * x for x in (seen.accuracy, seen.balanced_accuracy, held.accuracy, held.balanced_accuracy, by_batch)]
            rows.append((approach, name, split, epoch, *scores, time.perf_counter() - begin))
        return rows

    cells = [(a, m, s) for a in approaches for m in models for s in range(1, k + 1)]
    try:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            rows = [row for part in pool.map(run, cells) for row in part]
    finally:
        data.unpersist()
    return indexed.sparkSession.createDataFrame(rows, EXPERIMENT_SCHEMA)


def member_path(folder: str, approach: str, model: str, split: int) -> str:
    return f"{folder}/{approach}-{model}-{split}"


def trained_members(log: DataFrame, folder: str, approach: str, model: str, start: float = 10.0) -> dict:
    """The saved models of the splits that got above ``start``, by name."""
    best = best_of_splits(log, start).where((F.col("approach") == approach) & (F.col("model") == model) & F.col("best_accuracy").isNotNull())
    splits_kept = sorted(r["split"] for r in best.select("split").collect())
    kind = neural.MultilayerPerceptronClassificationModel
    return {f"split_{s}": store.load_model(member_path(folder, approach, model, s), kind) for s in splits_kept}


def ensemble_of_trained(df: DataFrame, features: str, label: str, members: Mapping, classes: Sequence) -> DataFrame:
    """``ensemble_eval`` of trained models on test rows, each model's probabilities computed once."""
    scored = df.select(features, label)
    for i, model in enumerate(members.values()):
        scored = neural.score_mlp(model, scored, features).drop("pred").withColumnRenamed("probs", f"_probs{i}")
    return ensemble_eval(scored, label, {name: F.col(f"_probs{i}") for i, name in enumerate(members)}, classes)


def best_of_splits(log: DataFrame, start: float = 10.0) -> DataFrame:
    """The epoch with the best validation accuracy of each cell, the earliest on ties.

    A cell that never gets above ``start`` has no best, and counts with its time all the same.
    """
    packed = F.when(F.col("accuracy") > start, F.struct("accuracy", (-F.col("epoch")).alias("e"), "epoch", "balanced_accuracy"))
    picked = log.groupBy("approach", "model", "split").agg(F.max(packed).alias("b"), F.max("seconds").alias("seconds"))
    return picked.select(
        "approach", "model", "split", F.col("b.accuracy").alias("best_accuracy"),
        F.col("b.balanced_accuracy").alias("best_balanced_accuracy"), F.col("b.epoch").alias("last_improvement"), "seconds",
    )


def experiment_summary(best: DataFrame) -> DataFrame:
    """Mean and three deviations over the splits of each scheme and model, of the scores and of the time."""
    return best.groupBy("approach", "model").agg(
        F.count(F.lit(1)).alias("n_splits"),
        F.count("best_accuracy").alias("n_improved"),
        F.avg("best_accuracy").alias("accuracy"),
        (3 * F.stddev_samp("best_accuracy")).alias("accuracy_three_sigma"),
        F.avg("best_balanced_accuracy").alias("balanced_accuracy"),
        (3 * F.stddev_samp("best_balanced_accuracy")).alias("balanced_three_sigma"),
        F.sum("seconds").alias("total_seconds"),
        F.avg("seconds").alias("seconds"),
        (3 * F.stddev_samp("seconds")).alias("seconds_three_sigma"),
    )
