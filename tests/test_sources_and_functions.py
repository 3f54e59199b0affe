import numpy as np
import pytest
from pyspark.sql import functions as F

from momentloom.functions import arrays, scalars
from momentloom.operators import linear, profile, schema, steps
from momentloom.operators.logistic import LogisticTask, fit_logistic, fit_logistic_models, score
from momentloom.sources import generate, models, store, tables


def test_wide_csv(spark, tmp_path):
    path = tmp_path / "images.csv"
    path.write_text("label,1x1,1x2,2x1\n5,0,128,255\n0,1,2,3\n")
    rows = tables.load_wide_csv(spark, str(path), "label", ["1x1", "1x2", "2x1"]).collect()
    assert [(r["label"], r["values"]) for r in rows] == [(5, [0.0, 128.0, 255.0]), (0, [1.0, 2.0, 3.0])]


def test_csv_with_another_header_is_refused(spark, tmp_path):
    path = tmp_path / "images.csv"
    path.write_text("label,b,a\n5,0,128\n")
    with pytest.raises(Exception):
        tables.load_wide_csv(spark, str(path), "label", ["a", "b"]).collect()


def test_model_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([(float(i), int(i % 3 == 0)) for i in range(30)], "x double, y int")
    model = fit_logistic(df, "y", ["x"])
    for _ in range(2):
        store.save_model(model, str(tmp_path / "deep" / "folder" / "model"))
    loaded = store.load_model(str(tmp_path / "deep" / "folder" / "model"))
    assert score(loaded, df).collect() == score(model, df).collect()


def test_log_appends(spark, tmp_path):
    schema_text = "epoch int, loss double"
    for epoch in (1, 3, 5):
        store.log_metrics(store.metrics_rows(spark, [{"epoch": epoch, "loss": 1.0 / epoch}], schema_text), str(tmp_path / "log"))
    assert [r["epoch"] for r in spark.read.parquet(str(tmp_path / "log")).orderBy("epoch").collect()] == [1, 3, 5]


def test_param_grid_order(spark):
    rows = tables.param_grid(spark, features=["a", "ab"], lam=tables.log_scale(1e-3, 10, 3)).orderBy("candidate").collect()
    assert [r["candidate"] for r in rows] == list(range(6))
    assert [(r["features"], round(r["lam"], 6)) for r in rows] == [(f, l) for f in ("a", "ab") for l in (0.001, 0.1, 10.0)]


def test_literal_table(spark):
    assert tables.literal_table(spark, {"Lag1": [1.2, 1.5], "Lag2": [1.1, -0.8]}).count() == 2
    with pytest.raises(ValueError):
        tables.literal_table(spark, {"a": [1], "b": [1, 2]})


def test_gumbel_grid_moments(spark):
    row = profile.mean_std(generate.gumbel_grid(spark.range(100_000), "id"), "x").first()
    assert row["mean"] == pytest.approx(0.5772, abs=1e-3) and row["std"] == pytest.approx(1.2825, abs=2e-3)


def test_seeded_numbers_do_not_depend_on_placement(spark):
    once = generate.uniform(spark.range(200), "id", 3, 4).collect()
    again = generate.uniform(spark.range(200).repartition(7), "id", 3, 4).collect()
    assert {r["id"]: r["u"] for r in once} == {r["id"]: r["u"] for r in again}


def test_spirals_turn_both_ways(spark):
    rows = generate.spirals(spark.range(4).withColumnRenamed("id", "k"), "k", 10)
    assert rows.count() == 40
    assert {(r["seq_id"], r["label"]) for r in rows.collect()} == {(0, 0), (1, 0), (2, 1), (3, 1)}


def test_spirals_hash_a_key_once(spark):
    """The start is made below the step that lays out the points, not again for each of them."""
    plan = generate.spirals(spark.range(4).withColumnRenamed("id", "k"), "k", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and plan.index("Generate") < plan.index("md5(")


def test_rounding(spark):
    row = spark.range(1).select(
        scalars.round_significant(F.lit(3.14159), 3).alias("pi"),
        scalars.round_significant(F.lit(0.0), 3).alias("zero"),
        scalars.round_significant(F.lit(-12345.0), 2).alias("minus"),
        scalars.round_digits(F.lit(1e300), 6).alias("large"),
        scalars.round_digits(F.lit(None).cast("double"), 2).alias("none"),
        scalars.fixed_text(F.lit(2.005), 1).alias("text"),
    ).first()
    assert row["pi"] == pytest.approx(3.14) and row["zero"] == 0 and row["minus"] == pytest.approx(-12000)
    assert row["large"] == 1e300 and row["none"] is None and row["text"] == "2.0"


def test_wrap_and_padding(spark):
    row = spark.range(1).select(
        scalars.wrap_one_based(F.lit(8), 8).alias("a"), scalars.wrap_one_based(F.lit(9), 8).alias("b"), scalars.wrap_one_based(F.lit(0), 8).alias("c"),
        scalars.pad_right(F.lit("Crim"), 8).alias("d"), scalars.pad_left(F.lit("toolongname"), 4).alias("e"),
    ).first()
    assert tuple(row) == (8, 1, 8, "Crim    ", "toolongname")


def test_matrix_functions_against_numpy(spark):
    m = np.arange(12.0).reshape(3, 4)
    flat = m.flatten(order="F").tolist()
    df = spark.createDataFrame([(flat,)], "a array<double>")
    row = df.select(
        arrays.transpose("a", 3, 4).alias("t"), arrays.flip_rows("a", 3, 4).alias("f"), arrays.upright("a", 3, 4).alias("u"),
        arrays.matrix_row("a", 2, 3, 4).alias("r"), arrays.matrix_column("a", 3, 3).alias("c"), arrays.cell("a", 3, 2, 3).alias("x"),
    ).first()
    assert row["t"] == m.T.flatten(order="F").tolist()
    assert row["f"] == m[::-1].flatten(order="F").tolist()
    assert row["u"] == m.T[::-1].flatten(order="F").tolist()
    assert row["r"] == m[1].tolist() and row["c"] == m[:, 2].tolist() and row["x"] == m[2, 1]


def test_pooling_keeps_a_quarter(spark):
    image = np.random.default_rng(1).random((28, 28))
    df = spark.createDataFrame([(image.flatten(order="F").tolist(),)], "a array<double>")
    got = df.select(arrays.pool("a", 28, 28).alias("p")).first()["p"]
    want = image.reshape(14, 2, 14, 2).mean(axis=(1, 3)).flatten(order="F")
    assert len(got) == 196 and got == pytest.approx(want)


def test_layers_with_missing_inputs(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,), ([None, 1.0],)], "x array<double>")
    for outputs in (2, 400):
        got = [r[0] for r in df.select(arrays.dense("x", np.ones((outputs, 2)), np.zeros(outputs))).collect()]
        assert got[0] == [3.0] * outputs and got[1] is None and got[2] == [None] * outputs


def test_special_values_stay_themselves(spark):
    row = spark.createDataFrame([(float("nan"), float("inf"), float("-inf"), 0.0, 1234.567, None)], "a double, b double, c double, d double, e double, f double")
    got = row.select(*[scalars.round_significant(c, 3).alias(c) for c in "abcdef"]).first()
    assert np.isnan(got["a"]) and got["b"] == float("inf") and got["c"] == float("-inf") and got["d"] == 0 and got["e"] == 1230 and got["f"] is None


def test_histogram_leaves_out_what_is_no_number(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r["n"] for r in profile.histogram(df, "v", 2).orderBy("bin").collect()] == [1, 2]
    assert tuple(profile.left_out(df, "v").first()) == (1, 1, 1)


def test_layers_equal_matrix_products(spark):
    rng = np.random.default_rng(2)
    w, b = rng.normal(size=(30, 100)), rng.normal(size=30)
    x = rng.normal(size=(7, 100))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    for activation, f in ((None, lambda z: z), ("relu", lambda z: np.maximum(z, 0)), ("sigmoid", lambda z: 1 / (1 + np.exp(-z)))):
        wide = np.array([r[0] for r in df.select(arrays.dense("x", w, b, activation)).collect()])
        assert wide == pytest.approx(f(x @ w.T + b))
    few = np.array([r[0] for r in df.select(arrays.dense("x", w[:5], b[:5], "relu")).collect()])
    assert few == pytest.approx(np.maximum(x @ w[:5].T + b[:5], 0))


def test_softmax_of_large_scores(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 0.0],)], "a array<double>")
    row = df.select(arrays.softmax("a").alias("p"), arrays.log_sum_exp("a").alias("l")).first()
    assert row["p"] == pytest.approx([0.5, 0.5, 0.0]) and row["l"] == pytest.approx(1000 + np.log(2))


def test_profiles_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a double, s string")
    row = {r["variable"]: r for r in profile.describe(empty).collect()}["a"]
    assert row["mean"] is None and row["median"] is None and row["nmissing"] == 0
    flat = spark.createDataFrame([(4.0,), (4.0,), (None,)], "a double")
    bins = profile.histogram(flat, "a", 3).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [2, 0, 0]
    spread = spark.range(1000).select((F.col("id") * 1.0).alias("v"))
    total = profile.histogram(spread, "v", 7, normalize=True).agg(F.sum(F.col("density") * (F.col("high") - F.col("low")))).first()[0]
    assert total == pytest.approx(1)


def test_schema_operations(spark):
    df = spark.createDataFrame([(1, 2.0, "Up")], "a int, b double, s string")
    y, x = schema.split_target(df, lambda c: c == "b")
    assert (y.columns, x.columns) == (["b"], ["a", "s"])
    assert dict(schema.discrete_to_continuous(df).dtypes)["a"] == "double"
    assert schema.coerce(df, {"s": ["Down", "Up"]}).first()["s"] == 1
    assert schema.coerce(df, {"s": ["Left"]}).first()["s"] is None
    assert schema.with_intercept(df).columns[0] == "constant"
    assert schema.poly_feature_names(["a", "b"], 2) == ["a_1", "a_2", "b_1", "b_2"]
    assert schema.schema_table(df).collect()[1]["name"] == "b"


def test_wide_csv_tells_bad_rows_apart(spark, tmp_path):
    path = tmp_path / "images.csv"
    path.write_text("label,b,a\n5,0,128\n1,x,2\n2,3\n3,1,2,3\n4,,7\n")
    good, bad = tables.load_wide_csv_checked(spark, str(path), "label", ["b", "a"])
    assert sorted((r["label"], r["values"]) for r in good.collect()) == [(4, [None, 7.0]), (5, [0.0, 128.0])]
    assert sorted(r["bad_record"] for r in bad.collect()) == ["1,x,2", "2,3", "3,1,2,3"]
    assert (good.count(), bad.count()) == (2, 3)
    with pytest.raises(ValueError):
        tables.load_wide_csv_checked(spark, str(path), "label", ["a", "b"])


def test_product_of_rows_and_a_matrix(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, []), (6, [0.5, -1.0])]
    df = spark.createDataFrame(rows, "id int, a array<double>").coalesce(1)
    weights = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    got = {r["id"]: r["p"] for r in df.select("id", arrays.product("a", weights).alias("p")).collect()}
    assert got[0] == [9.0, 12.0, 15.0] and got[6] == [-3.5, -4.0, -4.5]
    assert [got[i] for i in (1, 2, 4, 5)] == [None] * 4 and np.isnan(got[3]).all()
    assert df.where("id < 0").select(arrays.product("a", weights)).collect() == []
    assert df.where("id = 4").select(arrays.dense("a", np.transpose(weights), [0.0] * 3).alias("d")).first()["d"] is None


def test_models_of_every_kind_survive_the_model_table(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i * i % 7), float(i % 3 == 0), 3.5) for i in range(40)], "a double, b double, y double, flat double")
    place = str(tmp_path / "deep" / "models")
    standard, parts = linear.standardize_fit(df, ["a", "flat"]), linear.pca_fit(df, ["a", "b"])
    chain = steps.pipeline([steps.Standardize(), steps.Regress("y")], df, ["a", "b"])
    regression, classes = linear.linear_regression(df, "y", ["a", "b"]), fit_logistic_models(df, "y", {"all": LogisticTask(("a", "b"))})["all"]
    for name, model in {"standard": standard, "chain": chain, "regression": regression, "classes": classes}.items():
        assert models.save(spark, model, place, name) == 1 and models.load(spark, place, name) == model
    models.save(spark, parts, place, "parts")
    assert models.load(spark, place, "parts").transform(df).collect() == parts.transform(df).collect()
    assert models.save(spark, linear.ridge(df, "y", ["a"], 1.0), place, "regression") == 2
    assert models.load(spark, place, "regression").features == ("a",) and models.load(spark, place, "regression", 1) == regression
    assert models.versions(spark, place).count() == 6
    for name, version in (("none", None), ("chain", 2)):
        with pytest.raises(KeyError):
            models.load(spark, place, name, version)
    with pytest.raises(TypeError):
        models.save(spark, object(), place, "odd")
