"""Fitted models: least squares, ridge, polynomials, components, logistic regression, perceptrons."""

from __future__ import annotations

from uuid import uuid4

import numpy as np
from pyspark.sql import functions as F

from momentloom.catalog.common import TEXT_SQL, rounded, significant, text_measures
from momentloom.catalog.profiles import BETA, LINEAR_SQL, SPIRAL_SQL
from momentloom.catalog.registry import REGISTRY, analysis
from momentloom.catalog.sqltext import covariances, eliminate, hash32, newton, rd, regression, rs
from momentloom.functions import arrays
from momentloom.operators import linear, metrics, neural, schema, sequences, splits, steps
from momentloom.operators.logistic import LogisticTask, fit_logistic, fit_logistic_models, score
from momentloom.operators.moments import collect_moments, collect_vector_moments
from momentloom.operators.ordered import cumulative_ratio
from momentloom.plans import evaluation
from momentloom.session import ensure_checkpoint_dir
from momentloom.sources import generate, models
from momentloom.sources.tables import grid, literal_table, load

TEXT_XS = ["n_spaces", "n_lines", "n_e"]
TEXT_COLS = [*TEXT_XS, "n_chars"]


def _normal_equations(source, xs, y, tag):
    items = [f"sum({a}*{b}) as m_{i}_{j}" for i, a in enumerate(xs) for j, b in enumerate(xs)]
    items += [f"sum({a}*{y}) as m_{i}_{len(xs)}" for i, a in enumerate(xs)]
    chain, last = eliminate(f"{tag}s", len(xs), [], tag)
    return f"{tag}s as (select {', '.join(items)} from {source}),\n{chain}", last


_ols, _ols_last = _normal_equations("t", ["constant", "x1", "x2", "x3"], "y", "e")


@analysis(
    "L1 A11 U4 S7",
    f"with t as (select 1e0 as constant, * from {LINEAR_SQL}), {_ols} "
    + " union all ".join(f"select '{c}' as term, {rd(f'm_{i}_4')} as value from {_ols_last}" for i, c in enumerate(["constant", "x1", "x2", "x3"])),
)
def ols_recovery(spark, folder):
    """Least squares on generated data, which must find the coefficients it was made with."""
    rows = schema.with_intercept(generate.linear(load(spark, folder, "orders"), "o_orderkey", BETA, 1.0, 31))
    model = linear.ols(rows, "y", ["constant", "x1", "x2", "x3"])
    return rounded(linear.coef_table(spark, model).where(F.col("term") != "Intercept"))


_cov = covariances("t", TEXT_COLS, [], "c")
_lin, _lin_last = regression("c", [0, 1, 2], 3, [], "l")


def _coef_rows(last, names, digits):
    rows = [f"select '{c}' as term, {rs(f'b_{i}', digits)} as value from {last}" for i, c in enumerate(names)]
    return " union all ".join(rows + [f"select 'Intercept', {rs('b0', digits)} from {last}"])


@analysis("L2 L9 F3", f"with t as {TEXT_SQL}, {_cov}, {_lin} " + _coef_rows(_lin_last, TEXT_XS, 6))
def text_length_regression(spark, folder):
    model = linear.linear_regression(text_measures(spark, folder), "n_chars", TEXT_XS)
    return linear.coef_table(spark, model, 6)


@analysis(
    "L2 M1 M2",
    f"""with t as {TEXT_SQL}, {_cov}, {_lin}, p as (select t.*, b0 + b_0*n_spaces + b_1*n_lines + b_2*n_e as p from t, {_lin_last})
    select {rd('1e0 - sum(pow(n_chars-p, 2))/(var_pop(n_chars)*count(*))')} as r2, {rd('sqrt(avg(pow(n_chars-p, 2)))', 3)} as rms from p""",
)
def text_length_fit_quality(spark, folder):
    rows = text_measures(spark, folder)
    model = linear.linear_regression(rows, "n_chars", TEXT_XS)
    made = model.predict(rows).agg(metrics.r_squared("n_chars", "prediction").alias("r2"), metrics.rms("n_chars", "prediction").alias("rms"))
    return rounded(made, 6, rms=3)


_rl, _rl_last = regression("c", [0, 1], 2, [], "r", lam=0.1)


@analysis("L4", f"with {covariances('lineitem', ['l_quantity', 'l_discount', 'l_extendedprice'], [], 'c')}, {_rl} " + _coef_rows(_rl_last, ["l_quantity", "l_discount"], 6))
def ridge_price(spark, folder):
    model = linear.ridge(load(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], 0.1)
    return linear.coef_table(spark, model, 6)


@analysis(
    "P7 L2 M1",
    f"with t as (select *, l_discount*l_tax as interaction from lineitem), {covariances('t', ['l_quantity', 'l_discount', 'l_tax', 'interaction', 'l_extendedprice'], [], 'c')}, "
    + ", ".join([regression("c", [0, 1, 2], 4, [], "less")[0], regression("c", [0, 1, 2, 3], 4, [], "more")[0]])
    + f" select 'with' as model, {rd('(b_0*v_0_4 + b_1*v_1_4 + b_2*v_2_4 + b_3*v_3_4)/v_4_4', 9)} as r2 from moref, c"
    + f" union all select 'without', {rd('(b_0*v_0_4 + b_1*v_1_4 + b_2*v_2_4)/v_4_4', 9)} from lessf, c",
)
def interaction_gain(spark, folder):
    """R2 with and without a product term, both from one scan."""
    rows = schema.interaction(load(spark, folder, "lineitem"), "l_discount", "l_tax")
    xs = ["l_quantity", "l_discount", "l_tax", "interaction"]
    m = collect_moments(rows, [*xs, "l_extendedprice"]).total()
    scores = [(name, linear.r2_of(m, linear.solve_linear(m, "l_extendedprice", cols))) for name, cols in (("without", xs[:3]), ("with", xs))]
    return rounded(spark.createDataFrame(scores, "model string, r2 double"), 9)


_scaled = "with e as (select min(p_partkey) as lo, max(p_partkey) as hi from part), t as (select (p_partkey - (lo+hi)/2e0)/((hi-lo)/2e0) as t1, p_retailprice as y from part, e), d as (select *, t1*t1 as t2, t1*t1*t1 as t3 from t), "


@analysis(
    "L3 S4 P16",
    _scaled + covariances("d", ["t1", "t2", "t3", "y"], [], "c") + ", "
    + ", ".join(regression("c", list(range(k)), 3, [], f"g{k}")[0] for k in (1, 2, 3))
    + ", x as (select s, lo + (hi-lo)*s/99e0 as x, -1e0 + 2e0*s/99e0 as u from e, (select unnest(range(100)) as s)) "
    + f"select s::int as step, {rd('x', 4)} as p_partkey, {rd('g1f.b0 + g1f.b_0*u', 5)} as order_1, {rd('g2f.b0 + g2f.b_0*u + g2f.b_1*u*u', 5)} as order_2, "
    + f"{rd('g3f.b0 + g3f.b_0*u + g3f.b_1*u*u + g3f.b_2*u*u*u', 5)} as order_3 from x, g1f, g2f, g3f",
)
def polynomial_curves(spark, folder):
    """Polynomials of order 1 to 3 fitted and drawn over the extent of the feature."""
    table = load(spark, folder, "part")
    points = grid(table, "p_partkey", 100)
    curves = []
    for degree in (1, 2, 3):
        model, interval = linear.polyfit(table, "p_partkey", "p_retailprice", degree)
        powers = linear.power_model(model, interval)
        value = F.lit(0.0)
        for b in reversed(powers.coefs):
            value = (value + F.lit(b)) * F.col("p_partkey")
        curves.append((value + F.lit(powers.intercept)).alias(f"order_{degree}"))
    return rounded(points.select("step", "p_partkey", *curves), 5, p_partkey=4)


@analysis(
    "L3 M1",
    _scaled + covariances("d", ["t1", "t2", "t3", "y"], [], "c") + ", " + ", ".join(regression("c", list(range(k)), 3, [], f"g{k}")[0] for k in (1, 2, 3)) + " "
    + " union all ".join(f"select {k} as degree, {rd('(' + ' + '.join(f'b_{i}*v_{i}_3' for i in range(k)) + ')/v_3_3', 8)} as r2 from g{k}f, c" for k in (1, 2, 3)),
)
def polynomial_quality(spark, folder):
    interval = linear.extent(load(spark, folder, "part"), "p_partkey")
    basis = linear.legendre_columns(load(spark, folder, "part"), interval, 3, keep=["p_retailprice"])
    m = collect_moments(basis, ["P1", "P2", "P3", "p_retailprice"]).total()
    rows = [(k, linear.r2_of(m, linear.solve_linear(m, "p_retailprice", [f"P{j}" for j in range(1, k + 1)]))) for k in (1, 2, 3)]
    return rounded(spark.createDataFrame(rows, "degree int, r2 double"), 8)


@analysis(
    "E1",
    "with m as (select avg(c_acctbal) as a, stddev_samp(c_acctbal) as s, avg(c_nationkey) as a2, stddev_samp(c_nationkey) as s2 from customer where c_mktsegment <> 'BUILDING') "
    f"select c_custkey, {rd('(c_acctbal-a)/s')} as c_acctbal, {rd('(c_nationkey-a2)/s2')} as c_nationkey from customer, m",
)
def standardized_customers(spark, folder):
    """Fitted on the customers of four segments, applied to all."""
    table = load(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    fitted = linear.standardize_fit(table.where(F.col("c_mktsegment") != "BUILDING"), ["c_acctbal", "c_nationkey"])
    return rounded(fitted.apply(table).drop("c_mktsegment"))


@analysis(
    "E2 E1",
    "with m as (select avg(l_quantity) as a, stddev_samp(l_quantity) as s from lineitem) "
    f"select l_returnflag, {rd('avg((l_quantity-a)/s)')} as mean, {rd('stddev_samp((l_quantity-a)/s)')} as std from lineitem, m group by 1",
)
def selected_then_standardized(spark, folder):
    """Select before standardising: the scan reads two columns instead of all."""
    table = load(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    made = linear.standardize_fit(table, ["l_quantity"]).apply(table)
    return rounded(made.groupBy("l_returnflag").agg(F.avg("l_quantity").alias("mean"), F.stddev_samp("l_quantity").alias("std")))


@analysis(
    "E3 L2",
    f"with t as {TEXT_SQL}, {covariances('t', ['n_spaces', 'n_lines', 'n_chars'], [], 'c')}, {regression('c', [0, 1], 2, [], 'l')[0]} "
    f"select doc_id, {rd('b0 + b_0*n_spaces + b_1*n_lines', 2)} as prediction from t, lf",
)
def chained_steps(spark, folder):
    """Scaling, selection and regression fitted as one chain, in the order that reads least."""
    rows = text_measures(spark, folder)
    chain = [steps.Standardize(), steps.Select(("n_spaces", "n_lines")), steps.Regress("n_chars")]
    made = steps.pipeline(chain, rows, ["n_spaces", "n_lines", "n_e", "n_marks"]).transform(rows, keep=["doc_id"])
    return rounded(made.select("doc_id", "prediction"), 2)


def _models_folder(spark):
    """A new folder for models beside the checkpoints, which executors share; the caller of the analysis removes it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/models-{uuid4().hex}"


@analysis("S9 S10 E3 L2", REGISTRY["chained_steps"].sql)
def saved_chain_scored(spark, folder):
    """The chain of ``chained_steps`` saved as the second version of its name, read back, and applied."""
    rows = text_measures(spark, folder)
    chain = [steps.Standardize(), steps.Select(("n_spaces", "n_lines")), steps.Regress("n_chars")]
    place = _models_folder(spark)
    models.save(spark, linear.LinearModel("n_chars", (), (), 0.0, 0), place, "chain")
    models.save(spark, steps.pipeline(chain, rows, ["n_spaces", "n_lines", "n_e", "n_marks"]), place, "chain")
    made = models.load(spark, place, "chain").transform(rows, keep=["doc_id"])
    return rounded(made.select("doc_id", "prediction"), 2)


_eigen3 = """with r as (select corr(l_quantity, l_discount) as a, corr(l_quantity, l_tax) as b, corr(l_discount, l_tax) as c from lineitem),
  p as (select *, sqrt((a*a + b*b + c*c)/3e0) as p from r), q as (select *, acos(least(greatest(a*b*c/(p*p*p), -1e0), 1e0))/3e0 as phi from p),
  v as (select 1 as component, 1 + 2*p*cos(phi) as variance from q union all select 3, 1 + 2*p*cos(phi + 2.0943951023931953e0) from q
    union all select 2, 1 - 2*p*cos(phi) - 2*p*cos(phi + 2.0943951023931953e0) + 0 from q) """


@analysis("L6 W1", _eigen3 + f"select component, {rd('variance')} as variance, {rd('sum(variance) over (order by component)/3e0')} as cumulative_ratio from v")
def component_variances(spark, folder):
    """Eigenvalues of the correlation matrix of three columns, against their closed form."""
    fitted = linear.pca_fit(load(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    table = fitted.table(spark).select("component", "variance")
    return rounded(cumulative_ratio(table, "variance", "component"))


@analysis(
    "L6",
    f"""with t as {TEXT_SQL}, m as (select avg(n_spaces) as a, stddev_samp(n_spaces) as s, avg(n_lines) as a2, stddev_samp(n_lines) as s2, corr(n_spaces, n_lines) as r from t),
    z as (select doc_id, (n_spaces-a)/s as z1, (n_lines-a2)/s2 as z2, r from t, m)
    select doc_id, {rd('(z1 + sign(r)*z2)/sqrt(2e0)')} as pc1, {rd('(z1 - sign(r)*z2)/sqrt(2e0)')} as pc2 from z""",
)
def component_projections(spark, folder):
    rows = text_measures(spark, folder)
    fitted = linear.pca_fit(rows, ["n_spaces", "n_lines"])
    return rounded(fitted.transform(rows, keep=["doc_id"]))


@analysis("S9 S10 L6", REGISTRY["component_projections"].sql)
def saved_components_projected(spark, folder):
    """The components of ``component_projections`` saved, read back, and used."""
    rows = text_measures(spark, folder)
    place = _models_folder(spark)
    models.save(spark, linear.pca_fit(rows, ["n_spaces", "n_lines"]), place, "components")
    return rounded(models.load(spark, place, "components").transform(rows, keep=["doc_id"]))


@analysis(
    "L6",
    f"select label, count(*) as n, {rd('avg(list_sum(list_transform(embedding, lambda x: x::double * x::double)))')} as mean_square from embeddings group by 1",
)
def projected_lengths_kept(spark, folder):
    """Vectors times an orthogonal matrix of their size, as components are projected: their lengths stay."""
    turn = np.linalg.qr(np.random.default_rng(5).normal(size=(64, 64)))[0]
    turned = load(spark, folder, "embeddings").select("label", arrays.product("embedding", turn).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return rounded(turned.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg(square).alias("mean_square")))


@analysis(
    "L6",
    f"""with e as (select embedding::double[] as v from embeddings), r as (select corr(v[i], v[j]) as r from e, (select unnest(range(1, 65)) as i), (select unnest(range(1, 65)) as j) group by i, j)
    select 64::bigint as components, {rd('64e0', 5)} as total, {rd('sum(r*r)', 5)} as total_of_squares from r""",
)
def embedding_component_sums(spark, folder):
    """Variances of all components: they sum to their number, and their squares to those of all correlations."""
    m = collect_vector_moments(load(spark, folder, "embeddings"), "embedding", 64).total()
    v = linear.components_from(m, m.cols).table(spark)
    return rounded(v.agg(F.count(F.lit(1)).alias("components"), F.sum("variance").alias("total"), F.sum(F.col("variance") * F.col("variance")).alias("total_of_squares")), 5)


@analysis("L6 W1")
def embedding_components(spark, folder):
    """All 64 components of the embeddings, from sums of products formed in Arrow batches."""
    m = collect_vector_moments(load(spark, folder, "embeddings"), "embedding", 64).total()
    table = linear.components_from(m, m.cols).table(spark).select("component", "variance")
    return rounded(cumulative_ratio(table, "variance", "component"))


@analysis(
    "L5",
    f"select l_linestatus, {rd('avg((l_discount > 0.05e0)::int)', 5)} as p from lineitem group by 1",
)
def saturated_probabilities(spark, folder):
    """With one two-valued feature the fitted probabilities are the group means."""
    rows = load(spark, folder, "lineitem").select(
        "l_linestatus", (F.col("l_linestatus") == "O").cast("double").alias("open"), (F.col("l_discount") > 0.05).cast("int").alias("y")
    )
    model = fit_logistic(rows, "y", ["open"])
    return rounded(score(model, rows.select("l_linestatus", "open").distinct()).select("l_linestatus", "p"), 5)


FLAG_XS = ["l_discount", "l_tax", "l_quantity"]
_newton, _newton_last = newton("d", FLAG_XS, "y", "n", 6)
FLAG_SQL = "(select 1 as k, (l_returnflag = 'R')::int as y, l_discount, l_tax, l_quantity/10e0 as l_quantity, l_shipdate from lineitem)"


def flag_rows(spark, folder):
    return load(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_discount", "l_tax", (F.col("l_quantity") / 10.0).alias("l_quantity"), "l_shipdate", "l_orderkey"
    )


@analysis(
    "L5 L9",
    f"with d as {FLAG_SQL}, {_newton} " + " union all ".join(f"select '{c}' as term, {rd(f'w{i}', 5)} as value from {_newton_last}" for i, c in [(1, FLAG_XS[0]), (2, FLAG_XS[1]), (3, FLAG_XS[2]), (0, "Intercept")]),
)
def logistic_coefficients(spark, folder):
    model = fit_logistic_models(flag_rows(spark, folder), "y", {"all": LogisticTask(tuple(FLAG_XS))})["all"]
    return rounded(linear.coef_table(spark, model), 5)


_quality_newton, _quality_last = newton("d", ["n_spaces", "n_lines"], "quality", "n", 9)
QUALITY_SQL = f"(select 1 as k, doc_id, n_spaces/1000e0 as n_spaces, n_lines/100e0 as n_lines, quality from labels join {TEXT_SQL} t using (doc_id))"


def quality_rows(spark, folder):
    rows = load(spark, folder, "labels").join(text_measures(spark, folder), "doc_id")
    return rows.select("doc_id", (F.col("n_spaces") / 1000.0).alias("n_spaces"), (F.col("n_lines") / 100.0).alias("n_lines"), "quality")


@analysis(
    "L5 M5 M6 M7",
    f"""with d as {QUALITY_SQL}, {_quality_newton}, s as (select quality, 1e0/(1e0+exp(-(w0 + w1*n_spaces + w2*n_lines))) as p from d, {_quality_last})
    select count(*) as n, {rd('avg(-(quality*ln(p) + (1-quality)*ln(1e0-p)))', 4)} as cross_entropy, {rd('avg(((p > 0.5e0)::int = quality)::int)', 4)} as accuracy,
    {rd('avg(((p > 0.5e0)::int <> quality)::int)', 4)} as misclassification from s""",
)
def quality_classifier(spark, folder):
    """Document quality from counts over the text, scored on the rows it was fitted on."""
    rows = quality_rows(spark, folder)
    scored = score(fit_logistic(rows, "quality", ["n_spaces", "n_lines"]), rows)
    return rounded(
        scored.agg(
            F.count(F.lit(1)).alias("n"),
            metrics.binary_cross_entropy("quality", "p").alias("cross_entropy"),
            metrics.accuracy("quality", "pred").alias("accuracy"),
            metrics.misclassification_rate("quality", "pred").alias("misclassification"),
        ),
        4,
    )


@analysis(
    "S3 P16 L5",
    f"with d as {FLAG_SQL}, {_newton}, x as (select unnest([0.02e0, 0.08e0]) as l_discount, unnest([0.05e0, 0.01e0]) as l_tax, unnest([1e0, 4e0]) as l_quantity) "
    f"select l_discount, l_tax, l_quantity, {rd(f'1e0/(1e0+exp(-(w0 + w1*l_discount + w2*l_tax + w3*l_quantity)))', 5)} as p, (w0 + w1*l_discount + w2*l_tax + w3*l_quantity > 0)::int as pred from x, {_newton_last}",
)
def new_rows_scored(spark, folder):
    """A model fitted on all line items predicts two rows written out in the program."""
    model = fit_logistic_models(flag_rows(spark, folder), "y", {"all": LogisticTask(tuple(FLAG_XS))})["all"]
    new = literal_table(spark, {"l_discount": [0.02, 0.08], "l_tax": [0.05, 0.01], "l_quantity": [1.0, 4.0]})
    return rounded(new.select("*", model.probability().alias("p"), model.predicted().alias("pred")), 5)


IMAGE_LAYERS = [16, 14, 14, 10]


def pooled_images(spark, folder):
    return load(spark, folder, "embeddings").select("vec_id", arrays.pool("embedding", 8, 8).alias("image"), "label")


@analysis("L7 F12")
def perceptron_accuracy(spark, folder):
    """A small perceptron on pooled images: loss and accuracies on the rows it was fitted on and on others."""
    parts = splits.train_test_split(pooled_images(spark, folder), "vec_id", 0.8, 21)
    train, test = (parts.where(F.col("split") == p) for p in ("train", "test"))
    model = neural.fit_mlp(neural.training_rows(train, "image", "label"), IMAGE_LAYERS, 40)
    seen, held = (neural.quality(model, part, "image", "label") for part in (train, test))
    row = (neural.parameter_count(IMAGE_LAYERS), int(model.weights.size), seen.loss, seen.accuracy, held.loss, held.accuracy, held.balanced_accuracy)
    return rounded(spark.createDataFrame([row], "expected_weights int, weights int, loss double, accuracy double, test_loss double, test_accuracy double, test_balanced_accuracy double"))


_line, _line_last = _normal_equations("t", ["constant", "l_quantity", "l_discount", "l_tax"], "l_extendedprice", "q")


@analysis(
    "L1 U4",
    f"with t as (select 1e0 as constant, * from lineitem), {_line} "
    + " union all ".join(f"select '{c}' as term, {rs(f'm_{i}_4', 6)} as value from {_line_last}" for i, c in enumerate(["constant", "l_quantity", "l_discount", "l_tax"])),
)
def ols_line_items(spark, folder):
    """Least squares with a constant column on all line items."""
    rows = schema.with_intercept(load(spark, folder, "lineitem").select("l_extendedprice", "l_quantity", "l_discount", "l_tax"))
    model = linear.ols(rows, "l_extendedprice", ["constant", "l_quantity", "l_discount", "l_tax"])
    return significant(linear.coef_table(spark, model).where(F.col("term") != "Intercept"), 6)


@analysis(
    "L8 W8",
    f"""with n as (select user_id, value as x, event_id % 97 + 1e0 as y, lead(value) over w as nx, lead(event_id % 97 + 1e0) over w as ny from events window w as (partition by user_id order by ts))
    select user_id, count(*) as n_points, {rd('sum(x*ny - nx*y)', 4)} as signed_area, {rd('sum(sqrt(pow(nx-x,2)+pow(ny-y,2)))', 4)} as path_length from n group by 1""",
)
def event_paths(spark, folder):
    """Each user's events in time order as a path of points, and how it turns."""
    points = load(spark, folder, "events").select("user_id", "ts", F.col("value").alias("x"), (F.pmod("event_id", F.lit(97)) + 1.0).alias("y"))
    made = sequences.sequence_features(points, "user_id", "ts")
    return rounded(made.select("user_id", "n_points", "signed_area", "path_length"), 4)


_areas = f"(select seq_id, any_value(label) as label, sum(x*ny - nx*y) as area from (select *, lead(x) over w as nx, lead(y) over w as ny from {SPIRAL_SQL} window w as (partition by seq_id order by step)) group by 1)"


@analysis(
    "L8 R1",
    f"""select count(*) as n_test, {rd('avg(((area > 0)::int = label)::int)')} as accuracy from {_areas} where {hash32('seq_id', 80)} >= 3435973837""",
)
def spiral_classifier(spark, folder):
    """Which way a spiral turns, learned from sequence features on 80 percent of the sequences."""
    points = generate.spirals(load(spark, folder, "customer"), "c_custkey", 40)
    labels = generate.spirals(load(spark, folder, "customer"), "c_custkey", 1).select("seq_id", "label")
    ensure_checkpoint_dir(spark)
    # The fit and the scores both read the features; their points are sorted once.
    rows = sequences.sequence_features(points).join(labels, "seq_id").checkpoint(eager=True)
    parts = splits.train_test_split(rows, "seq_id", 0.8, 80)
    made = evaluation.compare_feature_sets(parts, "label", {"turning": ["signed_area", "mean_turn"]})
    return rounded(made.select(F.col("n_test"), "accuracy"))
