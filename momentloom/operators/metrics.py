"""Regression and classification metrics.

Those that are one aggregate are functions from columns to a Column, to be used in ``agg`` with or
without ``groupBy``. Those that need two levels are functions of a DataFrame; the inner level is
combined before its shuffle, so a class or batch with most of the rows does no harm.

One rule holds for all: a row whose truth or prediction is missing is not scored. ``not_scored`` counts such rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.functions import arrays
from momentloom.functions.scalars import column

SMALLEST_PROBABILITY = 2.220446049250313e-16


# Regression ---------------------------------------------------------------------------------

def r_squared(y: Column | str, p: Column | str) -> Column:
    """1 - SSE/SST. Negative when worse than the mean; null when the truth does not vary."""
    y, p = column(y).cast("double"), column(p).cast("double")
    both = y.isNotNull() & p.isNotNull()
    sse = F.sum(F.pow(y - p, F.lit(2.0)))
    sst = F.var_pop(F.when(both, y)) * F.count_if(both)
    return F.lit(1.0) - F.try_divide(sse, sst)


def mean_squared_error(y: Column | str, p: Column | str) -> Column:
    return F.avg(F.pow(column(y).cast("double") - column(p).cast("double"), F.lit(2.0)))


def rms(y: Column | str, p: Column | str) -> Column:
    return F.sqrt(mean_squared_error(y, p))


# Probabilities ------------------------------------------------------------------------------

def probability_loss(p_true: Column | str) -> Column:
    """Cross-entropy of one row from the probability given to its true class."""
    return -F.log(F.greatest(column(p_true).cast("double"), F.lit(SMALLEST_PROBABILITY)))


def cross_entropy(p_true: Column | str) -> Column:
    return F.avg(probability_loss(p_true))


def logit_loss(logits: Column | str, class_index: Column | str) -> Column:
    """Cross-entropy of one row from raw scores; ``class_index`` counts from 0."""
    true_logit = F.element_at(arrays.doubles(logits), column(class_index).cast("int") + 1)
    return arrays.log_sum_exp(logits) - true_logit


def logit_cross_entropy(logits: Column | str, class_index: Column | str) -> Column:
    return F.avg(logit_loss(logits, class_index))


def binary_loss(y: Column | str, p: Column | str) -> Column:
    """Cross-entropy of one row with truth 0/1 and the probability of 1."""
    y, p = column(y).cast("double"), column(p).cast("double")
    low = F.lit(SMALLEST_PROBABILITY)
    yes, no = F.log(F.greatest(p, low)), F.log(F.greatest(F.lit(1.0) - p, low))
    return -(y * yes + (F.lit(1.0) - y) * no)


def binary_cross_entropy(y: Column | str, p: Column | str) -> Column:
    return F.avg(binary_loss(y, p))


# Labels -------------------------------------------------------------------------------------

def _share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def not_scored(y: Column | str, pred: Column | str) -> Column:
    """Rows whose truth or prediction is missing."""
    return F.count_if(column(y).isNull() | column(pred).isNull())


def accuracy(y: Column | str, pred: Column | str) -> Column:
    return _share(column(pred) == column(y))


def misclassification_rate(y: Column | str, pred: Column | str) -> Column:
    return _share(column(pred) != column(y))


def threshold_accuracy(y: Column | str, p: Column | str, threshold: float = 0.5) -> Column:
    """Accuracy of the rule "1 when p is strictly above the threshold"."""
    return _share((column(p) > F.lit(threshold)) == (column(y) == 1))


def true_positives(y: Column | str, pred: Column | str, positive) -> Column:
    return F.count_if((column(pred) == F.lit(positive)) & (column(y) == F.lit(positive)))


def false_positives(y: Column | str, pred: Column | str, positive) -> Column:
    return F.count_if((column(pred) == F.lit(positive)) & (column(y) != F.lit(positive)))


def false_negatives(y: Column | str, pred: Column | str, positive) -> Column:
    return F.count_if((column(pred) != F.lit(positive)) & (column(y) == F.lit(positive)))


def true_negatives(y: Column | str, pred: Column | str, positive) -> Column:
    return F.count_if((column(pred) != F.lit(positive)) & (column(y) != F.lit(positive)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def precision(y: Column | str, pred: Column | str, positive) -> Column:
    tp = true_positives(y, pred, positive)
    return _ratio(tp, tp + false_positives(y, pred, positive))


def recall(y: Column | str, pred: Column | str, positive) -> Column:
    tp = true_positives(y, pred, positive)
    return _ratio(tp, tp + false_negatives(y, pred, positive))


def f1_score(y: Column | str, pred: Column | str, positive) -> Column:
    twice = 2 * true_positives(y, pred, positive)
    wrong = false_positives(y, pred, positive) + false_negatives(y, pred, positive)
    return _ratio(twice, twice + wrong)


def false_positive_rate(y: Column | str, pred: Column | str, positive) -> Column:
    fp = false_positives(y, pred, positive)
    return _ratio(fp, fp + true_negatives(y, pred, positive))


def binary_report(y: str, pred: str, positive) -> list[Column]:
    """All label metrics of a two-class problem, for one ``agg``."""
    return [
        F.count_if(F.col(y).isNotNull() & F.col(pred).isNotNull()).alias("n"),
        accuracy(y, pred).alias("accuracy"),
        misclassification_rate(y, pred).alias("misclassification"),
        false_positives(y, pred, positive).alias("false_positives"),
        precision(y, pred, positive).alias("precision"),
        recall(y, pred, positive).alias("recall"),
        f1_score(y, pred, positive).alias("f1"),
        false_positive_rate(y, pred, positive).alias("fpr"),
    ]


def most_probable(probabilities: Column | str, classes: Sequence) -> Column:
    """The class with the largest probability; the first on ties."""
    return arrays.decode(probabilities, classes)


# Two-level metrics --------------------------------------------------------------------------

def confusion_matrix(df: DataFrame, y: str, pred: str, levels: Sequence = ()) -> DataFrame:
    """Counts per (predicted, truth) that occur, missing labels as null, and zeros for all pairs of ``levels``.

    Labels that ``levels`` does not list keep rows of their own, so the counts always add up to the rows.
    """
    counts = df.groupBy(F.col(pred).alias("predicted"), F.col(y).alias("truth")).agg(F.count(F.lit(1)).alias("n"))
    if not levels:
        return counts
    every = F.array(*[F.lit(v) for v in levels])
    cells = df.sparkSession.range(1).select(F.explode(every).alias("predicted"))
    cells = cells.select("predicted", F.explode(every).alias("truth"), F.lit(0).cast("bigint").alias("n"))
    return counts.union(cells).groupBy("predicted", "truth").agg(F.sum("n").alias("n"))


def accuracy_from_confusion(confusion: DataFrame) -> DataFrame:
    """The same accuracy as from the rows, whatever levels were listed."""
    right = F.sum(F.when(F.col("predicted") == F.col("truth"), F.col("n")).otherwise(0))
    scored = F.sum(F.when(F.col("predicted").isNotNull() & F.col("truth").isNotNull(), F.col("n")))
    return confusion.agg(_ratio(right, scored).alias("accuracy"))


def recall_by_class(df: DataFrame, y: str, pred: str) -> DataFrame:
    """True positives, size and recall of each class that occurs in the truth of a scored row."""
    hit = F.count_if(F.col(pred) == F.col(y))
    counted = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()).groupBy(F.col(y).alias("class")).agg(hit.alias("tp"), F.count(F.lit(1)).alias("total"))
    return counted.select("class", "tp", "total", _ratio(F.col("tp"), F.col("total")).alias("recall"))


def balanced_accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Mean recall over the classes present in the truth; null for an empty table."""
    return recall_by_class(df, y, pred).agg(
        F.count(F.lit(1)).alias("n_classes"), F.avg("recall").alias("balanced_accuracy")
    )


def batch_balanced_accuracy(df: DataFrame, batch: str, y: str, pred: str) -> DataFrame:
    """Balanced accuracy of each batch. A class that a batch lacks does not count in it."""
    per_class = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()).groupBy(batch, y).agg(_share(F.col(pred) == F.col(y)).alias("recall"))
    return per_class.groupBy(batch).agg(F.avg("recall").alias("balanced_accuracy"))


def mean_batch_balanced_accuracy(df: DataFrame, batch: str, y: str, pred: str) -> DataFrame:
    """The plain mean over batches, which differs from the value over all rows."""
    return batch_balanced_accuracy(df, batch, y, pred).agg(
        F.count(F.lit(1)).alias("n_batches"), F.avg("balanced_accuracy").alias("balanced_accuracy")
    )


def epoch_summary(df: DataFrame, epoch: str, batch: str, loss: Column, correct: Column) -> DataFrame:
    """Per epoch: the sum of the batches' mean losses and the mean of their accuracies."""
    per_batch = df.groupBy(epoch, batch).agg(F.avg(loss).alias("loss"), _share(correct).alias("accuracy"))
    return per_batch.groupBy(epoch).agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("loss").alias("loss"), F.avg("accuracy").alias("accuracy")
    )


def fold_interval(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and three sample deviations over folds; no deviation from a single fold."""
    return df.groupBy(*by).agg(
        F.count(value).alias("n_folds"), F.avg(value).alias("mean"), (3 * F.stddev_samp(value)).alias("three_sigma")
    )


def best_fold_stats(df: DataFrame, score: str) -> DataFrame:
    """Squared mean and squared deviation of per-fold RMS values.

    The second is the variance of the RMS, not the deviation of the squared errors.
    """
    return df.agg(
        F.pow(F.avg(score), F.lit(2.0)).alias("mse_mean"), F.pow(F.stddev_samp(score), F.lit(2.0)).alias("mse_std")
    )


def ensemble_mean(df: DataFrame, key: Sequence[str], probabilities: str, classes: int) -> DataFrame:
    """Mean probability of each class over the rows (ensemble members) of a key.

    One average per class instead of unfolding the arrays: the shuffle carries one partial row
    per key and task.
    """
    means = [F.avg(F.element_at(F.col(probabilities), i + 1)).alias(f"p{i}") for i in range(classes)]
    return df.groupBy(*key).agg(*means).select(*key, F.array(*[f"p{i}" for i in range(classes)]).alias(probabilities))


def member_mean(members: Sequence[Column | str], classes: int) -> Column:
    """The same mean where the members are columns of one row: no shuffle."""
    cols = [arrays.doubles(m) for m in members]
    first = F.struct(*[c.alias(f"m{i}") for i, c in enumerate(cols)])
    cells = lambda s: F.array(
        *[
            sum((F.element_at(s[f"m{m}"], i + 1) for m in range(1, len(cols))), F.element_at(s["m0"], i + 1)) / F.lit(float(len(cols)))
            for i in range(classes)
        ]
    )
    return arrays.bind(first, cells)
