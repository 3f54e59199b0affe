import pytest
from pyspark.sql import functions as F

from momentloom.operators import metrics


def frame(spark, rows):
    return spark.createDataFrame(rows, "y string, pred string")


def test_identities(spark):
    df = frame(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")])
    row = df.agg(metrics.accuracy("y", "pred").alias("acc"), metrics.misclassification_rate("y", "pred").alias("mis")).first()
    assert row["acc"] == pytest.approx(0.6) and row["acc"] + row["mis"] == pytest.approx(1)
    confusion = metrics.confusion_matrix(df, "y", "pred", ["a", "b", "c"])
    assert metrics.confusion_matrix(df, "y", "pred").count() == 4
    assert confusion.count() == 9 and confusion.agg(F.sum("n")).first()[0] == 5
    assert metrics.accuracy_from_confusion(confusion).first()[0] == pytest.approx(0.6)
    assert metrics.balanced_accuracy(df, "y", "pred").first()["balanced_accuracy"] == pytest.approx((0.5 + 1 + 0) / 3)


def test_balanced_accuracy_counts_classes_of_the_truth_only(spark):
    df = frame(spark, [("a", "a"), ("a", "z")])
    row = metrics.balanced_accuracy(df, "y", "pred").first()
    assert (row["n_classes"], row["balanced_accuracy"]) == (1, 0.5)


def test_batch_mean_differs_from_the_whole(spark):
    df = spark.createDataFrame([(0, "a", "a"), (0, "a", "a"), (1, "a", "b"), (1, "b", "b")], "batch int, y string, pred string")
    assert metrics.mean_batch_balanced_accuracy(df, "batch", "y", "pred").first()["balanced_accuracy"] == pytest.approx(0.75)
    assert metrics.balanced_accuracy(df, "y", "pred").first()["balanced_accuracy"] == pytest.approx((2 / 3 + 1) / 2)


def test_empty_tables_give_null(spark):
    df = frame(spark, [])
    row = df.agg(*metrics.binary_report("y", "pred", "a")).first()
    assert row["n"] == 0 and row["accuracy"] is None and row["precision"] is None and row["f1"] is None
    assert metrics.balanced_accuracy(df, "y", "pred").first()["balanced_accuracy"] is None
    numbers = spark.createDataFrame([], "y double, p double")
    assert numbers.agg(metrics.r_squared("y", "p").alias("r")).first()["r"] is None


def test_no_positive_predictions(spark):
    df = frame(spark, [("a", "b"), ("b", "b")])
    row = df.agg(*metrics.binary_report("y", "pred", "a")).first()
    assert row["precision"] is None and row["recall"] == 0 and row["fpr"] == 0


@pytest.mark.parametrize(
    "rows,expected",
    [
        ([(1.0, 1.0), (2.0, 2.0)], 1.0),
        ([(1.0, 1.5), (2.0, 1.5)], 0.0),
        ([(1.0, 9.0), (2.0, 9.0)], 1 - (64 + 49) / 0.5),
        ([(1.0, 2.0)], None),
        ([(3.0, 2.0), (3.0, 3.0)], None),
        ([(1.0, 1.0), (2.0, 2.0), (None, 5.0), (100.0, None)], 1.0),
    ],
)
def test_r_squared(spark, rows, expected):
    got = spark.createDataFrame(rows, "y double, p double").agg(metrics.r_squared("y", "p").alias("r")).first()["r"]
    assert got is None if expected is None else got == pytest.approx(expected)


def test_large_offset_keeps_digits(spark):
    df = spark.range(1000).select((F.col("id") + 1e9).alias("y"), (F.col("id") + 1e9 + 0.5).alias("p"))
    row = df.agg(metrics.r_squared("y", "p").alias("r"), metrics.rms("y", "p").alias("e")).first()
    assert row["e"] == pytest.approx(0.5)
    assert row["r"] == pytest.approx(1 - 1000 * 0.25 / (1000 * (1000**2 - 1) / 12), rel=1e-9)


def test_losses_survive_certain_predictions(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0)], "y int, p double")
    loss = df.agg(metrics.binary_cross_entropy("y", "p").alias("l")).first()["l"]
    assert 10 < loss < 40


def test_tied_probabilities_take_the_first_class(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],)], "p array<double>")
    assert df.select(metrics.most_probable("p", ["x", "y", "z"])).first()[0] == "x"


def test_ensemble_mean_of_rows_and_of_columns_agree(spark):
    rows = spark.createDataFrame([(1, [0.2, 0.8]), (1, [0.6, 0.4]), (2, [1.0, 0.0])], "k int, p array<double>")
    got = {r["k"]: r["p"] for r in metrics.ensemble_mean(rows, ["k"], "p", 2).collect()}
    assert got[1] == pytest.approx([0.4, 0.6]) and got[2] == [1.0, 0.0]
    wide = spark.createDataFrame([([0.2, 0.8], [0.6, 0.4])], "a array<double>, b array<double>")
    assert wide.select(metrics.member_mean(["a", "b"], 2)).first()[0] == pytest.approx([0.4, 0.6])


def test_one_fold_has_no_interval(spark):
    row = metrics.fold_interval(spark.createDataFrame([("m", 0.5)], "model string, acc double"), ["model"], "acc").first()
    assert row["mean"] == 0.5 and row["three_sigma"] is None


def test_missing_labels_are_scored_nowhere(spark):
    df = spark.createDataFrame([(0, "a", "a"), (0, "a", None), (0, None, "a"), (0, "b", "b"), (0, "z", "a")], "batch int, y string, pred string")
    row = df.agg(metrics.accuracy("y", "pred").alias("a"), metrics.not_scored("y", "pred").alias("m")).first()
    assert row["a"] == pytest.approx(2 / 3) and row["m"] == 2
    assert metrics.balanced_accuracy(df, "y", "pred").first()["balanced_accuracy"] == pytest.approx((1 + 1 + 0) / 3)
    assert metrics.mean_batch_balanced_accuracy(df, "batch", "y", "pred").first()["balanced_accuracy"] == pytest.approx((1 + 1 + 0) / 3)
    for listed in ([], ["a"], ["a", "b", "c"]):
        confusion = metrics.confusion_matrix(df, "y", "pred", listed)
        assert confusion.agg(F.sum("n")).first()[0] == 5
        assert metrics.accuracy_from_confusion(confusion).first()[0] == pytest.approx(2 / 3)
