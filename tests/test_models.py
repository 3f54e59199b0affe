import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.sql import functions as F

from momentloom.catalog import REGISTRY
from momentloom.functions.scalars import seeded_normal, seeded_uniform
from momentloom.operators import linear, moments, neural, profile, splits, steps
from momentloom.operators.logistic import LogisticTask, fit_logistic, fit_logistic_models, score
from momentloom.plans import evaluation, screening
from momentloom.sources import generate, store


@pytest.fixture(scope="module")
def data(spark):
    base = spark.range(600).select(
        "id", (F.col("id") % 5).cast("int").alias("fold"), seeded_normal("id", 1).alias("a"), (seeded_normal("id", 2) * 3 + 100).alias("b"), seeded_normal("id", 3).alias("c")
    )
    return base.withColumn("y", 2 + 0.5 * F.col("a") - 0.3 * F.col("b") + 0.7 * seeded_normal("id", 4)).cache()


def matrix(df, cols):
    return df.select(*cols).toPandas().to_numpy()


def brute(x, y, lam=0.0):
    mean, my = x.mean(axis=0), y.mean()
    z = x - mean
    b = np.linalg.solve(z.T @ z + lam * len(x) * np.eye(x.shape[1]), z.T @ (y - my))
    return b, my - b @ mean


def test_recovers_known_coefficients(spark):
    rows = generate.linear(spark.range(4000).withColumnRenamed("id", "k"), "k", [0.1, 0.5, -0.3, 0.0], 1.0, 7)
    model = linear.linear_regression(rows, "y", ["x1", "x2", "x3"])
    for got, want in zip([model.intercept, *model.coefs], [0.1, 0.5, -0.3, 0.0]):
        assert abs(got - want) < 4 / np.sqrt(4000)


@pytest.mark.parametrize("lam", [0.0, 0.1])
def test_regression_against_numpy(data, lam):
    x, y = matrix(data, ["a", "b", "c"]), matrix(data, ["y"])[:, 0]
    b, b0 = brute(x, y, lam)
    model = linear.ridge(data, "y", ["a", "b", "c"], lam)
    assert model.coefs == pytest.approx(b, rel=1e-9) and model.intercept == pytest.approx(b0, rel=1e-9)


def test_error_from_moments_equals_error_on_rows(data):
    m = moments.collect_moments(data, ["a", "b", "c", "y"]).total()
    model = linear.solve_linear(m, "y", ["a", "b"])
    rows = data.select(F.sum(F.pow(F.col("y") - model.expression(), F.lit(2.0)))).first()[0]
    assert linear.squared_error(m, model) == pytest.approx(rows, rel=1e-9)


def test_perfect_fit_is_measured_on_rows(data):
    exact = data.withColumn("z", 3 + 2 * F.col("b"))
    m = moments.collect_moments(exact, ["b", "z"]).total()
    assert linear.r2_checked(exact, m, linear.solve_linear(m, "z", ["b"])) == pytest.approx(1.0, abs=1e-12)


def test_collinear_and_constant_columns(data):
    twice = data.withColumn("a2", F.col("a") * 2).withColumn("one", F.lit(4.0))
    model = linear.linear_regression(twice, "y", ["a", "a2", "one"])
    single = linear.linear_regression(data, "y", ["a"])
    assert model.rank == 1
    assert model.coefs[0] + 2 * model.coefs[1] == pytest.approx(single.coefs[0], rel=1e-8) and model.coefs[2] == 0
    corr = {(r["col_i"], r["col_j"]): r["r"] for r in profile.corr_matrix(twice, ["a", "a2", "one"]).collect()}
    assert corr[("a", "one")] is None and corr[("a", "a2")] == pytest.approx(1.0)
    scaled = linear.standardize_fit(twice, ["one"]).apply(twice.select("one"))
    assert scaled.agg(F.max(F.abs("one"))).first()[0] == 0


def test_missing_rows_are_left_out_and_empty_is_an_error(spark, data):
    holes = data.withColumn("y", F.when(F.col("id") % 7 != 0, F.col("y")))
    kept = data.where("id % 7 != 0")
    assert linear.linear_regression(holes, "y", ["a"]).coefs == pytest.approx(linear.linear_regression(kept, "y", ["a"]).coefs)
    with pytest.raises(ValueError):
        linear.linear_regression(data.where("id < 0"), "y", ["a"])


def test_search_equals_fitting_every_fold(data):
    cases = [["a"], ["a", "b"], ["a", "b", "c"]]
    found = screening.search_linear(data, "y", cases, "fold", [0.0, 0.1])
    fold = matrix(data, ["fold"])[:, 0]
    y = matrix(data, ["y"])[:, 0]
    for number, (case, lam) in enumerate((c, l) for c in cases for l in (0.0, 0.1)):
        x = matrix(data, case)
        errors = []
        for f in range(5):
            b, b0 = brute(x[fold != f], y[fold != f], lam)
            errors.append((y[fold == f] - x[fold == f] @ b - b0) ** 2)
        assert found.candidates[number][3] == pytest.approx(np.sqrt(np.concatenate(errors).mean()), rel=1e-9)
    assert found.candidates[found.best_index][3] == min(c[3] for c in found.candidates)


def test_standardized_penalty_equals_standardising_first(data):
    m = moments.collect_moments(data, ["a", "b", "y"]).total()
    model = linear.solve_linear(m, "y", ["a", "b"], 0.2, standardized=True)
    scaled = linear.standardize_fit(data, ["a", "b"]).apply(data.select("a", "b", "y"))
    other = linear.ridge(scaled, "y", ["a", "b"], 0.2)
    one = matrix(model.predict(data.orderBy("id")), ["prediction"])
    two = matrix(other.predict(scaled), ["prediction"])
    assert np.sort(one[:, 0]) == pytest.approx(np.sort(two[:, 0]), rel=1e-9)


def test_dropping_a_feature_never_helps_in_sample(data):
    rows = {r["dropped"]: r["r2"] for r in screening.screen_drop(data, "y", ["a", "b", "c"]).collect()}
    assert all(rows[""] >= r - 1e-12 for r in rows.values()) and len(rows) == 4


def test_screens_count_nan_as_missing(spark):
    odd = lambda name, at: F.when(F.col("id") % 7 == at, float("nan")).when(F.col("id") % 11 == at, None).otherwise(F.col(name))
    plain = spark.range(300).select("id", (F.col("id") % 12).alias("k"), seeded_normal("id", 1).alias("x"), seeded_normal("id", 2).alias("y"))
    rows = plain.withColumns({"x": odd("x", 1), "y": odd("y", 2)})
    dim = spark.range(12).select(F.col("id").alias("dk"), F.when(F.col("id") == 5, float("nan")).otherwise(seeded_normal("id", 9)).alias("z"))
    joined = rows.join(dim, F.col("k") == F.col("dk"), "left")
    data = joined.select("x", "z", "y").toPandas()
    want = {c: data[[c, "y"]].dropna().corr().iloc[0, 1] ** 2 for c in ("x", "z")}
    assert {r["feature"]: r["r2"] for r in screening.screen_univariate(joined, "y", ["x", "z"]).collect()} == pytest.approx(want, rel=1e-9)
    star = screening.screen_univariate_star(rows, "k", "y", ["x"], dim, "dk", ["z"])
    assert {r["feature"]: r["r2"] for r in star.collect()} == pytest.approx(want, rel=1e-9)


def test_wide_components_project_in_one_expression(spark):
    rng = np.random.default_rng(2)
    d = 200
    cols = [f"c{i}" for i in range(d)]
    loadings = np.linalg.qr(rng.normal(size=(d, d)))[0]
    fitted = linear.Components(linear.Standardizer(tuple(cols), (1.0,) * d, (2.0,) * d), (1.0,) * d, float(d), loadings)
    x = rng.normal(size=(50, d))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").select(*[F.col("v")[i].alias(c) for i, c in enumerate(cols)])
    made = np.array([r["p"] for r in df.select(fitted.projection().alias("p")).collect()])
    assert np.allclose(made, (x - 1.0) / 2.0 @ loadings, atol=1e-12)
    assert np.allclose(fitted.transform(df).toPandas().to_numpy(), made, atol=1e-12)


def test_star_screen_equals_the_join(spark):
    fact = spark.range(900).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)).alias("k"), seeded_normal("id", 1).alias("x"), seeded_normal("id", 2).alias("y"))
    dim = spark.range(35).select(F.col("id").alias("dk"), seeded_normal("id", 9).alias("z"))
    for rows, features in ((fact, dim), (fact.withColumns({"x": F.when(F.col("x") > -0.5, F.col("x")), "y": F.when(F.col("y") < 1, F.col("y"))}), dim.withColumn("z", F.when(F.col("dk") % 4 != 0, F.col("z"))))):
        plain = {r["feature"]: r["r2"] for r in screening.screen_univariate(rows.join(features, F.col("k") == F.col("dk"), "left"), "y", ["x", "z"]).collect()}
        star = screening.screen_univariate_star(rows, "k", "y", ["x"], features, "dk", ["z"])
        assert {r["feature"]: r["r2"] for r in star.collect()} == pytest.approx(plain, rel=1e-9)


def test_tenth_degree_stays_accurate(spark):
    rows = spark.range(300).select((F.col("id") * 0.6 + 46).alias("x"), F.pmod("id", F.lit(10)).cast("int").alias("fold"))
    rows = rows.withColumn("y", F.sin(F.col("x") / 30)).cache()
    model, interval = linear.polyfit(rows, "x", "y", 10)
    basis = linear.legendre_columns(rows, interval, 10, keep=["x", "y"])
    assert basis.agg(F.max(F.abs(F.col("y") - model.expression()))).first()[0] < 1e-5
    table = screening.search_polynomial(rows, "x", "y", 10, "fold").table().toPandas()
    assert table["rms"].iloc[9] < table["rms"].iloc[2]


def test_power_model_predicts_the_same(data):
    model, interval = linear.polyfit(data, "b", "y", 3)
    powers = linear.power_model(model, interval)
    basis = linear.legendre_columns(data, interval, 3, keep=["b"])
    value = sum((F.lit(c) * F.pow("b", F.lit(float(d + 1))) for d, c in enumerate(powers.coefs)), F.lit(powers.intercept))
    assert basis.agg(F.max(F.abs(value - model.expression()))).first()[0] < 1e-6


def test_components(data):
    fitted = linear.pca_fit(data, ["a", "b", "c"])
    assert sum(fitted.variances) == pytest.approx(3) and fitted.ratios()[-1] == pytest.approx(1)
    pc = matrix(fitted.transform(data), ["pc1", "pc2", "pc3"])
    assert pc.mean(axis=0) == pytest.approx([0, 0, 0], abs=1e-9)
    assert np.cov(pc.T) == pytest.approx(np.diag(fitted.variances), abs=1e-9)
    lead = np.abs(fitted.loadings).argmax(axis=0)
    assert all(fitted.loadings[lead[k], k] > 0 for k in range(3))
    few = linear.pca_fit(data.withColumn("d", F.col("a") + F.col("c") * 0.001), ["a", "d"], variance_ratio=0.9)
    assert few.loadings.shape == (2, 1)


def test_batched_products_equal_sums(data):
    cols = ["a", "b", "c", "y"]
    plain = moments.collect_moments(data, cols, by="fold")
    vector = data.select("fold", F.array(*cols).alias("v"))
    batched = moments.collect_vector_moments(vector, "v", 4, by="fold")
    for f, m in plain.groups.items():
        assert batched.groups[f].n == m.n
        assert batched.groups[f].scatter() == pytest.approx(m.scatter(), rel=1e-8, abs=1e-8)
    table = {(r["fold"], r["i"], r["j"]): r["value"] for r in moments.gram(data, cols, by="fold").collect()}
    for f, m in plain.groups.items():
        assert [table[f, a, b] for i, a in enumerate(cols) for b in cols[i:]] == pytest.approx(list(m.raw()[np.triu_indices(4)]), rel=1e-8, abs=1e-8)
    assert len(table) == 10 * len(plain.groups)
    with pytest.raises(ValueError, match="gram"):
        moments.collect_moments(data, cols, by="id", limit=100)


def test_moments_of_reordered_rows_with_holes(spark):
    rows = [(i % 3, float(i) + 1e6, float(i * i % 17) if i % 5 else None, float("nan") if i == 7 else 1.0 * (i % 4)) for i in range(400)]
    one, two = (moments.collect_moments(spark.createDataFrame(r, "g int, a double, b double, c double"), ["a", "b", "c"], by="g") for r in (rows, rows[::-1]))
    assert one.total().n == sum(r[2] is not None and r[3] == r[3] for r in rows)
    for g, m in one.groups.items():
        assert m.scatter() == pytest.approx(two.groups[g].scatter(), rel=1e-10)


def test_embedding_components_against_numpy(spark):
    x = np.stack(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()["embedding"].to_numpy()).astype(float)
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    got = REGISTRY["embedding_components"].run(spark, "/root/testdata/sf0.001").orderBy("component").toPandas()
    assert got["variance"].to_numpy() == pytest.approx(want, abs=1e-6)
    assert got["cumulative_ratio"].to_numpy() == pytest.approx(np.cumsum(want) / 64, abs=1e-6)


@pytest.fixture(scope="module")
def classes(data):
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("a") * 1.5 + (F.col("b") - 100) * 0.2)))
    return data.withColumn("label", (seeded_uniform("id", 77) < p).cast("int")).cache()


def test_newton_equals_the_estimator(classes):
    made = fit_logistic_models(classes, "label", {"all": LogisticTask(("a", "b")), "part": LogisticTask(("a",), F.col("fold") != 0)})
    reference = fit_logistic(classes, "label", ["a", "b"]).stages[-1]
    assert made["all"].converged
    assert made["all"].coefs == pytest.approx(list(reference.coefficients), rel=1e-4)
    assert made["all"].intercept == pytest.approx(reference.intercept, rel=1e-4)
    part = fit_logistic(classes.where("fold <> 0"), "label", ["a"]).stages[-1]
    assert made["part"].coefs[0] == pytest.approx(part.coefficients[0], rel=1e-4)


def test_both_solvers_agree(classes):
    tasks = {"one": LogisticTask(("a",)), "two": LogisticTask(("a", "b"), F.col("fold") != 1)}
    newton = fit_logistic_models(classes, "label", tasks)
    other = fit_logistic_models(classes, "label", tasks, solver="estimator")
    assert list(other) == ["one", "two"] and other["one"].coefs == pytest.approx(newton["one"].coefs, rel=1e-4)
    assert other["two"].coefs == pytest.approx(newton["two"].coefs, rel=1e-4) and other["two"].converged


def test_missing_values_of_one_model_leave_the_others_alone(classes):
    holes = classes.withColumn("b", F.when(F.rand(3) > 0.3, F.col("b")))
    alone = fit_logistic_models(classes, "label", {"m": LogisticTask(("a",))})["m"]
    beside = fit_logistic_models(holes, "label", {"m": LogisticTask(("a",)), "n": LogisticTask(("a", "b"))})
    assert beside["m"].coefs == pytest.approx(alone.coefs, rel=1e-9)


def test_separable_classes_are_reported(spark):
    df = spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "x double, y int")
    model = fit_logistic_models(df, "y", {"m": LogisticTask(("x",))})["m"]
    assert not model.converged
    assert df.agg(F.avg((model.predicted() == F.col("y")).cast("double"))).first()[0] == 1.0


def test_cv_accuracy_scores_rows_by_unseen_models(classes):
    got = {r["fold"]: r["accuracy"] for r in evaluation.cv_accuracy(classes, "label", ["a", "b"], "fold", 5).collect()}
    for f in (0, 3):
        model = fit_logistic(classes.where(F.col("fold") != f), "label", ["a", "b"])
        held = score(model, classes.where(F.col("fold") == f))
        assert got[f] == pytest.approx(held.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0])


def test_components_do_as_well_as_features(classes):
    parts = splits.train_test_split(classes, "id", 0.7, 3)
    rows = {r["feature_set"]: r["accuracy"] for r in evaluation.compare_raw_and_components(parts, "label", ["a", "b"]).collect()}
    assert rows["original"] == rows["components"] > 0.6


def test_perceptron_learns_and_survives_saving(spark, tmp_path):
    rows = spark.range(300).select(F.array((F.col("id") % 2).cast("double"), seeded_uniform("id", 1)).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    model = neural.fit_mlp(neural.training_rows(rows, "x", "label"), [2, 4, 2], 60)
    assert model.weights.size == neural.parameter_count([2, 4, 2]) == 22
    assert neural.quality(model, rows, "x", "label").accuracy == 1.0
    store.save_model(model, str(tmp_path / "mlp"))
    loaded = store.load_model(str(tmp_path / "mlp"), MultilayerPerceptronClassificationModel)
    probs = lambda m: [r["probs"] for r in neural.score_mlp(m, rows, "x").limit(5).collect()]
    assert probs(loaded) == probs(model)


def test_parameter_counts_of_the_two_image_models():
    assert neural.parameter_count([784, 128, 64, 10]) == 109_386
    assert neural.parameter_count([64, 14, 10]) == 1_060


def test_experiment_covers_every_cell(spark):
    rows = spark.range(80).select(F.col("id").alias("row_id"), F.array((F.col("id") % 2).cast("double"), seeded_uniform("id", 1)).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    log = evaluation.cv_experiment(rows, "x", "label", {"small": [2, 2]}, 80, 2, epochs=2, steps=5)
    assert log.count() == 2 * 1 * 2 * 2
    summary = {r["approach"]: r for r in evaluation.experiment_summary(evaluation.best_of_splits(log)).collect()}
    assert set(summary) == {"StandardCV", "IndependentCV"} and summary["StandardCV"]["n_splits"] == 2


def test_nearly_exact_fits_are_measured_on_the_rows(spark):
    rows = spark.range(4000).select(F.pmod("id", F.lit(5)).cast("int").alias("fold"), seeded_normal("id", 1).alias("x"), seeded_normal("id", 2).alias("e"))
    rows = rows.withColumn("y", F.lit(1e5) + 3 * F.col("x") + 1e-4 * F.col("e")).cache()
    found = screening.search_linear(rows, "y", [["x"]], "fold").fold_table().toPandas().set_index("fold")["rms"]
    data = rows.toPandas()
    for f in range(5):
        train, held = data[data["fold"] != f], data[data["fold"] == f]
        slope, start = np.polyfit(train["x"], train["y"] - 1e5, 1)
        want = np.sqrt(((held["y"] - 1e5 - start - slope * held["x"]) ** 2).mean())
        assert found[f] == pytest.approx(want, rel=1e-5)


def test_folds_of_any_kind(spark):
    rows = spark.createDataFrame([(f, float(i), 2.0 * i + (i % 3)) for i, f in enumerate("abab" * 10)] + [(None, 1.0, 9.0)], "fold string, x double, y double")
    found = screening.search_linear(rows, "y", [["x"]], "fold")
    assert sorted(r["fold"] for r in found.fold_table().collect()) == ["a", "b"] and found.winner().first()["features"] == "x"
    holes = rows.withColumn("x", F.when(F.col("fold") != "b", F.col("x")))
    with pytest.raises(ValueError, match="without a complete row"):
        screening.search_linear(holes, "y", [["x"]], "fold")


def test_chained_steps_choose_before_they_scale(data):
    chain = [steps.Standardize(), steps.Select(("b", "a")), steps.Regress("y")]
    made = steps.pipeline(chain, data, ["a", "b", "c"])
    assert made.features == ("a", "b") and made.scaler.cols == ("a", "b")
    plain = linear.linear_regression(data, "y", ["a", "b"])
    one = {r["id"]: r["prediction"] for r in made.transform(data, keep=["id"]).collect()}
    two = {r["id"]: r["prediction"] for r in plain.predict(data).collect()}
    assert one == pytest.approx(two)
    assert steps.pipeline([steps.Select(("c",))], data, ["a", "c"]).transform(data).columns == ["c"]
    with pytest.raises(ValueError):
        steps.pipeline([steps.Select(("z",))], data, ["a"])


def test_a_split_without_a_best_counts_with_its_time(spark):
    log = spark.createDataFrame([("s", "m", 1, 1, 20.0, 15.0, 1.0), ("s", "m", 1, 2, 30.0, 18.0, 1.5), ("s", "m", 2, 1, 5.0, 5.0, 1.5)], "approach string, model string, split int, epoch int, accuracy double, balanced_accuracy double, seconds double")
    best = {r["split"]: r for r in evaluation.best_of_splits(log).collect()}
    assert best[1]["best_accuracy"] == 30 and best[1]["last_improvement"] == 2 and best[2]["best_accuracy"] is None
    row = evaluation.experiment_summary(evaluation.best_of_splits(log)).first()
    assert (row["n_splits"], row["n_improved"], row["total_seconds"], row["accuracy"]) == (2, 1, 3.0, 30.0)


def test_trained_members_vote_with_their_stored_weights(spark, tmp_path):
    rows = spark.range(240).select(F.col("id").alias("row_id"), F.array(seeded_normal("id", 1), seeded_normal("id", 2)).alias("v"))
    rows = rows.withColumn("label", (F.col("v")[0] + F.col("v")[1] > 0).cast("int"))
    log = evaluation.cv_experiment(rows, "v", "label", {"m": [2, 3, 2]}, 240, 3, epochs=2, steps=15, approaches=("IndependentCV",), batch=16, store_folder=str(tmp_path))
    assert log.count() == 6 and log.where("batch_balanced_accuracy is null or train_accuracy is null").count() == 0
    members = evaluation.trained_members(log, str(tmp_path), "IndependentCV", "m")
    assert list(members) == ["split_1", "split_2", "split_3"]
    table = {r["member"]: r["balanced_accuracy"] for r in evaluation.ensemble_of_trained(rows, "v", "label", members, [0, 1]).collect()}
    data = rows.toPandas()
    votes = [np.array([r["probs"] for r in neural.score_mlp(m, rows, "v").orderBy("row_id").collect()]) for m in members.values()]
    data["pred"] = np.mean(votes, axis=0).argmax(axis=1)
    want = (data["pred"] == data["label"]).groupby(data["label"]).mean().mean()
    assert table["ensemble"] == pytest.approx(want)
