"""Cross-validation experiments, ensembles, learning logs."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from momentloom.catalog.arrays import DIGITS
from momentloom.catalog.common import rounded
from momentloom.catalog.metrics import MEMBERS, _member, _member_rows
from momentloom.catalog.models import pooled_images
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import hash32, rd
from momentloom.functions.scalars import seeded_hash
from momentloom.operators import neural, ordered, splits
from momentloom.plans import evaluation
from momentloom.sources.store import log_metrics, metrics_rows
from momentloom.sources.tables import load

SCHEME_MODELS = {"MLP1": [16, 32, 16, 10], "MLP2": [16, 14, 10]}
SCHEME_FOLDS = 8


@analysis(
    "X9 A17 M15 M18",
    f"""with r as ({_member_rows}), a as (select vec_id, label, member::varchar as member, c, p from r union all select vec_id, label, 'ensemble', c, avg(p) from r group by 1, 2, 4),
    g as (select vec_id, label, member, arg_min(c, (-p)) as best from a group by 1, 2, 3),
    l as (select member, label, avg((best = label)::int) as recall from g group by 1, 2)
    select case when member = 'ensemble' then member else 'member_' || member end as member, {rd('avg(recall)')} as balanced_accuracy from l group by 1""",
)
def ensemble_against_members(spark, folder):
    """Each member's balanced accuracy beside that of the averaged probabilities, in one pass."""
    members = {f"member_{m}": _member(m) for m in range(MEMBERS)}
    return rounded(evaluation.ensemble_eval(load(spark, folder, "embeddings"), "label", members, DIGITS))


@analysis("X8 R4 R5")
def cv_schemes_compared(spark, folder):
    """Standard against independent cross-validation for a large and a small perceptron."""
    images = pooled_images(spark, folder)
    rows, n = ordered.row_index(images.withColumn("_h", seeded_hash("vec_id", 8)), ["_h", "vec_id"])
    log = evaluation.cv_experiment(rows, "image", "label", SCHEME_MODELS, n, SCHEME_FOLDS, epochs=2, steps=8)
    return evaluation.experiment_summary(evaluation.best_of_splits(log))


def _log_folder(spark):
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/learning-logs/{uuid4().hex}"


@analysis("X11")
def perceptron_learning_log(spark, folder):
    """Loss and accuracy on train and test rows at every other epoch of ten, from the appended log."""
    parts = splits.train_test_split(pooled_images(spark, folder), "vec_id", 0.8, 11)
    train, test = (parts.where(F.col("split") == p) for p in ("train", "test"))
    log = evaluation.learning_log(train, test, "image", "label", [16, 14, 10], epochs=10, steps=8, every=2)
    return _appended(spark, [metrics_rows(spark, [row], evaluation.LOG_SCHEMA) for row in log])


def _appended(spark, parts):
    """The parts appended to a log one after another, and read back."""
    place = _log_folder(spark)
    for part in parts:
        log_metrics(part, place)
    return spark.read.parquet(place)


@analysis("S11", "select o_orderpriority, count(*) as n, min(o_orderkey) as first_key from orders group by 1")
def appended_metrics(spark, folder):
    """A row for each priority, appended to the metrics log priority by priority."""
    rows = load(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))
    names = [r[0] for r in rows.select("o_orderpriority").distinct().collect()]
    return _appended(spark, [rows.where(F.col("o_orderpriority") == name) for name in sorted(names)])


EVENT_LOG = """(select event_type as approach, 'm' || (user_id % 2) as model, (user_id % 3 + 1)::int as split, event_id::int as epoch, value as accuracy,
    value / 2e0 as balanced_accuracy, (event_id % 1000) / 10e0 as seconds from events)"""


@analysis(
    "X8 A15 A16 W5 O3",
    f"""with b as (select approach, model, split, max(accuracy) filter (accuracy > 10e0) as a, max(seconds) as s from {EVENT_LOG} group by 1, 2, 3)
    select approach, model, count(*) as n_splits, count(a) as n_improved, {rd('avg(a)')} as accuracy, {rd('3*stddev_samp(a)')} as accuracy_three_sigma,
    {rd('avg(a/2e0)')} as balanced_accuracy, {rd('3*stddev_samp(a/2e0)')} as balanced_three_sigma, {rd('sum(s)')} as total_seconds, {rd('avg(s)')} as seconds,
    {rd('3*stddev_samp(s)')} as seconds_three_sigma from b group by 1, 2""",
)
def event_log_summary(spark, folder):
    """The summary of an experiment over a log made of the events."""
    log = load(spark, folder, "events").select(
        F.col("event_type").alias("approach"), F.concat(F.lit("m"), F.pmod("user_id", F.lit(2)).cast("string")).alias("model"),
        (F.pmod("user_id", F.lit(3)) + 1).cast("int").alias("split"), F.col("event_id").cast("int").alias("epoch"), F.col("value").alias("accuracy"),
        (F.col("value") / 2.0).alias("balanced_accuracy"), (F.pmod("event_id", F.lit(1000)) / 10.0).alias("seconds"),
    )
    return rounded(evaluation.experiment_summary(evaluation.best_of_splits(log)))


_shares = f"(select {hash32('vec_id', 11)} < 3435973837 as train, label from embeddings)"


@analysis("L7 X11", f"select count(*) filter (train) as n_train, count(*) filter (not train) as n_test, (16+1)*14 + (14+1)*10 as weights from {_shares}")
def perceptron_parts(spark, folder):
    """Rows on both sides of the split of the learning log, and the weights of its perceptron."""
    parts = splits.train_test_split(pooled_images(spark, folder), "vec_id", 0.8, 11)
    counts = parts.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    return counts.withColumn("weights", F.lit(neural.parameter_count([16, 14, 10])))


@analysis("X9 L7")
def trained_ensemble(spark, folder):
    """Perceptrons trained on disjoint blocks, kept at their best epoch, and their averaged probabilities on test rows."""
    parts = splits.train_test_split(pooled_images(spark, folder), "vec_id", 0.8, 12)
    rows, n = ordered.row_index(parts.where(F.col("split") == "train").withColumn("_h", seeded_hash("vec_id", 8)), ["_h", "vec_id"])
    place = f"{_log_folder(spark)}-models"
    log = evaluation.cv_experiment(rows, "image", "label", {"MLP": [16, 14, 10]}, n, 4, epochs=2, steps=20, approaches=("IndependentCV",), start=0.0, store_folder=place)
    members = evaluation.trained_members(log, place, "IndependentCV", "MLP", start=0.0)
    return rounded(evaluation.ensemble_of_trained(parts.where(F.col("split") == "test"), "image", "label", members, DIGITS))
