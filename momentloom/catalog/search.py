"""Feature screens and searches over models."""

from __future__ import annotations

from pyspark.sql import functions as F

from momentloom.catalog.common import TEXT_SQL, rounded, significant, text_measures
from momentloom.catalog.models import FLAG_SQL, FLAG_XS, flag_rows
from momentloom.catalog.registry import analysis
from momentloom.catalog.sqltext import covariances, hash32, newton, rd, regression, rs
from momentloom.operators import linear, metrics, ordered, schema, splits
from momentloom.plans import evaluation, screening
from momentloom.sources.tables import load, log_scale, spaced

STAR_XS = ["l_quantity", "l_discount", "l_tax"]
PART_XS = ["p_retailprice", "p_size"]


def _ranked(df, score="r2"):
    return df.orderBy(F.col(score).desc_nulls_last(), "feature")


@analysis(
    "X1 O2",
    "with t as (select * from lineitem join part on l_partkey = p_partkey) "
    + " union all ".join(f"select '{x}' as feature, {rd(f'regr_r2(l_extendedprice, {x})', 9)} as r2 from t" for x in STAR_XS + PART_XS),
)
def screen_price_features(spark, folder):
    """Which features of the line item or its part explain the price, each alone."""
    made = screening.screen_univariate_star(
        load(spark, folder, "lineitem"), "l_partkey", "l_extendedprice", STAR_XS, load(spark, folder, "part"), "p_partkey", PART_XS
    )
    return _ranked(rounded(made, 9))


SCREEN_TEXT = ["n_spaces", "n_lines", "n_e", "n_marks", "doc_id"]


@analysis("X1", f"with t as {TEXT_SQL} " + " union all ".join(f"select '{x}' as feature, {rd(f'regr_r2(n_chars, {x})')} as r2 from t" for x in SCREEN_TEXT))
def screen_text_features(spark, folder):
    return _ranked(rounded(screening.screen_univariate(text_measures(spark, folder), "n_chars", SCREEN_TEXT)))


DROP_XS = ["n_spaces", "n_lines", "n_e", "n_marks"]
DROP_SETS = [(), *[(x,) for x in DROP_XS], ("n_lines", "n_marks")]


def _drop_sql():
    chains, rows = [], []
    for s, dropped in enumerate(DROP_SETS):
        kept = [i for i, x in enumerate(DROP_XS) if x not in dropped]
        chain, last = regression("c", kept, 4, [], f"s{s}_")
        chains.append(chain)
        explained = " + ".join(f"b_{i}*v_{i}_4" for i in kept)
        rows.append(f"select '{'+'.join(dropped)}' as dropped, {len(kept)}::int as n_features, {rd(f'({explained})/v_4_4')} as r2 from c, {last}")
    return f"with t as {TEXT_SQL}, {covariances('t', [*DROP_XS, 'n_chars'], [], 'c')}, " + ", ".join(chains) + " " + " union all ".join(rows)


@analysis("X2", _drop_sql())
def screen_without_features(spark, folder):
    """R2 of the text length without each feature, and without two, beside the full model."""
    return rounded(screening.screen_drop(text_measures(spark, folder), "n_chars", DROP_XS, DROP_SETS))


def _cv_sql(source, xs, y, cases, lams, folds, standardized):
    """Brute force: coefficients per fold, joined back to the held-out rows."""
    cols = [*xs, y]
    at = {c: i for i, c in enumerate(cols)}
    chains = [
        f"f as (select distinct fold as held from {source})",
        f"j as (select s.*, f.held from {source} s join f on s.fold <> f.held)",
        covariances("j", cols, ["held"], "c"),
    ]
    rows = []
    for i, case in enumerate(cases):
        for k, lam in enumerate(lams):
            number = i * len(lams) + k
            chain, last = regression("c", [at[x] for x in case], at[y], ["held"], f"m{number}_", lam, standardized)
            chains.append(chain)
            fitted = " + ".join(["b0"] + [f"b_{at[x]}*{x}" for x in case])
            rows.append(f"select {number}::int as candidate, {len(case)}::int as n_features, {lam!r}::double as lam, held, pow({y} - ({fitted}), 2) as e from {source} s join {last} m on s.fold = m.held")
    return ", ".join(chains) + ", e as (" + " union all ".join(rows) + ")"


NESTED_XS = ["n_lines", "n_e", "n_spaces"]
TEXT_FOLDS = f"t as (select *, floor({hash32('doc_id', 5)}*5/4294967296e0)::int as fold from {TEXT_SQL})"


def folded_text(spark, folder):
    return text_measures(spark, folder).withColumn("fold", splits.hashed_fold("doc_id", 5, 5))


@analysis(
    "X3",
    f"with {TEXT_FOLDS}, " + _cv_sql("t", NESTED_XS, "n_chars", screening.prefixes(NESTED_XS), [0.0], 5, False)
    + f" select candidate, n_features, lam, {rs('sqrt(avg(e))', 7)} as rms from e group by 1, 2, 3",
)
def nested_features_cv(spark, folder):
    """Feature prefixes compared by five folds: one scan, every fit solved from its sums."""
    found = screening.search_linear(folded_text(spark, folder), "n_chars", screening.prefixes(NESTED_XS), "fold")
    return significant(found.table(), 7)


@analysis(
    "A18 O3 X3",
    f"with {TEXT_FOLDS}, " + _cv_sql("t", NESTED_XS, "n_chars", screening.prefixes(NESTED_XS), [0.0], 5, False)
    + """, g as (select candidate, held, count(*) as n, sqrt(avg(e)) as r from e group by 1, 2), b as (select candidate from e group by 1 order by avg(e), candidate limit 1)
    """ + f"select candidate, {rs('pow(avg(r), 2)', 7)} as mse_mean, {rs('var_samp(r)', 7)} as mse_std from g join b using (candidate) group by 1",
)
def best_fold_errors(spark, folder):
    found = screening.search_linear(folded_text(spark, folder), "n_chars", screening.prefixes(NESTED_XS), "fold")
    stats = metrics.best_fold_stats(found.best_folds(), "rms")
    return significant(stats.select(F.lit(found.best_index).alias("candidate"), "mse_mean", "mse_std"), 7)


_poly_parts = f"""ends as (select min(p_partkey) as lo, max(p_partkey) as hi from part),
  u as (select (p_partkey - (lo+hi)/2e0)/((hi-lo)/2e0) as x1, p_retailprice as y, floor({hash32('p_partkey', 10)}*10/4294967296e0)::int as fold from part, ends),
  t as (select *, x1*x1 as x2, x1*x1*x1 as x3, pow(x1, 4) as x4 from u)"""


@analysis(
    "X3 R7",
    f"with {_poly_parts}, " + _cv_sql("t", ["x1", "x2", "x3", "x4"], "y", screening.prefixes(["x1", "x2", "x3", "x4"]), [0.0], 10, False)
    + f" select n_features as degree, {rs('sqrt(avg(e))', 7)} as rms from e group by 1",
)
def polynomial_degree_cv(spark, folder):
    """Polynomials of degree 1 to 4 compared by ten folds on a basis that stays well conditioned."""
    rows = load(spark, folder, "part").withColumn("fold", splits.hashed_fold("p_partkey", 10, 10))
    found = screening.search_polynomial(rows, "p_partkey", "p_retailprice", 4, "fold")
    return significant(found.table().select(F.col("n_features").alias("degree"), "rms"), 7)


_ten = [f"x{k}" for k in range(1, 11)]
# The check uses Chebyshev polynomials, which span the same functions as the powers.
_ten_parts = f"""ends as (select min(p_partkey) as lo, max(p_partkey) as hi, count(*) // 10 as small, count(*) % 10 as longer from part),
  u as (select greatest(least((p_partkey - (lo+hi)/2e0)/((hi-lo)/2e0), 1e0), -1e0) as v, p_retailprice as y, row_number() over (order by p_partkey) - 1 as i, small, longer from part, ends),
  t as (select y, (case when i < longer*(small+1) then i // (small+1) else longer + (i - longer*(small+1)) // small end)::int as fold,
    {', '.join(f'cos({k}*acos(v)) as x{k}' for k in range(1, 11))} from u)"""


@analysis(
    "X3 P9 R6",
    f"with {_ten_parts}, " + _cv_sql("t", _ten, "y", screening.prefixes(_ten), [0.0], 10, False)
    + f" select n_features as degree, {rs('sqrt(avg(e))', 5)} as rms from e group by 1",
)
def polynomial_ten_degrees(spark, folder):
    """Degrees 1 to 10, with ten unshuffled folds."""
    numbered, n = ordered.row_index(load(spark, folder, "part").select("p_partkey", "p_retailprice"), ["p_partkey"])
    rows = numbered.withColumn("fold", splits.even_fold("row_id", n, 10))
    found = screening.search_polynomial(rows, "p_partkey", "p_retailprice", 10, "fold")
    return significant(found.table().select(F.col("n_features").alias("degree"), "rms"), 5)


GRID_COLS = ["l_quantity", "l_discount"]
GRID_XS = [f"{c}_{d}" for c in GRID_COLS for d in (1, 2)]
LAMS = log_scale(1e-3, 10.0, 3)
_grid_rows = f"""t as (select l_extendedprice as y, floor({hash32('l_orderkey', 3)}*5/4294967296e0)::int as fold, {', '.join(f'pow({c}, {d}) as {c}_{d}' for c in GRID_COLS for d in (1, 2))} from lineitem)"""


def grid_rows(spark, folder):
    table = load(spark, folder, "lineitem").withColumn("fold", splits.hashed_fold("l_orderkey", 5, 3))
    return schema.poly_features(table, GRID_COLS, 2, keep=["fold", "l_extendedprice"])


@analysis(
    "X4 L4 E1 E2 P10 F20",
    f"with {_grid_rows}, " + _cv_sql("t", GRID_XS, "y", screening.prefixes(GRID_XS), LAMS, 5, True)
    + f" select candidate, n_features, {rs('lam', 8)} as lam, {rs('sqrt(avg(e))', 8)} as rms from e group by 1, 2, 3",
)
def ridge_grid_search(spark, folder):
    """Four feature prefixes by three penalties by five folds: sixty fits from one scan."""
    found = screening.search_linear(grid_rows(spark, folder), "l_extendedprice", screening.prefixes(GRID_XS), "fold", LAMS, standardized=True)
    return significant(found.table(), 8)


@analysis(
    "X4 X6 F3",
    f"with {_grid_rows}, " + _cv_sql("t", GRID_XS, "y", screening.prefixes(GRID_XS), LAMS, 5, True)
    + f", r as (select candidate, n_features, lam, avg(e) as mse from e group by 1, 2, 3) select array_to_string({GRID_XS!r}[:n_features], '+') as features, n_features, {rs('lam', 8)} as lam, {rs('mse', 8)} as mse from r order by mse, candidate limit 1",
)
def ridge_grid_winner(spark, folder):
    """The features, penalty and held-out error of the winner of the grid."""
    found = screening.search_linear(grid_rows(spark, folder), "l_extendedprice", screening.prefixes(GRID_XS), "fold", LAMS, standardized=True)
    return significant(found.winner(), 8)


_best_chain = regression("c", [2, 1, 0], 3, [], "w")


@analysis(
    "X6 X3 P16",
    f"with t as {TEXT_SQL}, {covariances('t', ['n_spaces', 'n_e', 'n_lines', 'n_chars'], [], 'c')}, {_best_chain[0]} select doc_id, {rd('b0 + b_0*n_spaces + b_1*n_e + b_2*n_lines', 2)} as prediction from t, {_best_chain[1]}",
)
def winner_predictions(spark, folder):
    """The winner of the nested search, refitted on all rows, predicts every document."""
    rows = folded_text(spark, folder)
    found = screening.search_linear(rows, "n_chars", screening.prefixes(NESTED_XS), "fold")
    return rounded(found.best_model.predict(rows).select("doc_id", "prediction"), 2)


def _holdout_sql():
    chains, rows = [], []
    for k in (1, 2, 3):
        chain, last = regression("c", list(range(k)), 3, [], f"h{k}_")
        chains.append(chain)
        fitted = " + ".join(["b0"] + [f"b_{i}*t{i + 1}" for i in range(k)])
        mse = lambda part: rd(f"avg(pow(y - ({fitted}), 2)) filter ({part})", 5)
        rows.append(f"select 'order_{k}' as model, {k}::int as n_features, {mse('train')} as train_mse, {mse('not train')} as test_mse from d, {last}")
    return (
        "with e as (select min(p_partkey) as lo, max(p_partkey) as hi from part), "
        f"u as (select (p_partkey - (lo+hi)/2e0)/((hi-lo)/2e0) as t1, p_retailprice as y, {hash32('p_partkey', 444)} < 2147483648 as train from part, e), "
        "d as (select *, t1*t1 as t2, t1*t1*t1 as t3 from u), dt as (select * from d where train), "
        + covariances("dt", ["t1", "t2", "t3", "y"], [], "c") + ", " + ", ".join(chains) + " " + " union all ".join(rows)
    )


@analysis("X7 R1 M2 L3", _holdout_sql())
def holdout_polynomials(spark, folder):
    """Polynomials of order 1 to 3 fitted on one random half and measured on the other."""
    parts = splits.train_test_split(load(spark, folder, "part"), "p_partkey", 0.5, 444)
    interval = linear.extent(parts, "p_partkey")
    basis = linear.legendre_columns(parts, interval, 3, keep=["split", "p_retailprice"])
    cases = {f"order_{k}": [f"P{j}" for j in range(1, k + 1)] for k in (1, 2, 3)}
    return rounded(screening.holdout_errors(basis, "p_retailprice", cases), 5)


@analysis(
    "S4 L2 P16",
    f"with m as (select regr_slope(o_totalprice, o_custkey) as b, regr_intercept(o_totalprice, o_custkey) as a from orders) select s::int as step, {rd('50e0 + 175e0*s/99e0')} as o_custkey, "
    f"{rd('a + b*(50e0 + 175e0*s/99e0)', 4)} as prediction from m, (select unnest(range(100)) as s)",
)
def line_over_fixed_range(spark, folder):
    """A line fitted on all orders, drawn between two given ends."""
    model = linear.linear_regression(load(spark, folder, "orders"), "o_totalprice", ["o_custkey"])
    return rounded(model.predict(spaced(spark, 50, 225, 100, "o_custkey")), 4, o_custkey=6)


def _cv_logistic():
    chain, last = newton("j", FLAG_XS, "y", "n", 5, key="held")
    z = "w0 + w1*l_discount + w2*l_tax + w3*l_quantity"
    return (
        f"with d as (select *, floor({hash32('l_orderkey', 123)}*5/4294967296e0)::int as fold from (select (l_returnflag = 'R')::int as y, l_discount, l_tax, l_quantity/10e0 as l_quantity, l_orderkey from lineitem)), "
        f"f as (select distinct fold as held from d), j as (select d.*, f.held from d join f on d.fold <> f.held), {chain} "
        f"select fold, count(({z}) + y) as n, count(*) - count(({z}) + y) as n_not_scored, {rd(f'avg((({z} > 0)::int = y)::int)')} as accuracy from d join {last} b on b.held = d.fold group by 1"
    )


@analysis("X5 R7 L5", _cv_logistic())
def logistic_cv_accuracy(spark, folder):
    """Five shuffled folds of a logistic classifier, all fitted on shared scans."""
    rows = flag_rows(spark, folder).withColumn("fold", splits.hashed_fold("l_orderkey", 5, 123))
    return rounded(evaluation.cv_accuracy(rows, "y", FLAG_XS, "fold", 5))


@analysis("X5 A3", f"select count(*) as n_folds, {rd('avg(accuracy)', 4)} as mean_accuracy from ({_cv_logistic()})")
def logistic_cv_mean(spark, folder):
    """The mean over the five folds, to four digits."""
    rows = flag_rows(spark, folder).withColumn("fold", splits.hashed_fold("l_orderkey", 5, 123))
    return evaluation.mean_accuracy(rounded(evaluation.cv_accuracy(rows, "y", FLAG_XS, "fold", 5)))


def _two_sets(where_train, sets):
    chains, rows = [], []
    for name, xs in sets.items():
        chain, last = newton("tr", xs, "y", f"{name}_", 5)
        chains.append(chain)
        z = " + ".join(["w0"] + [f"w{i + 1}*{x}" for i, x in enumerate(xs)])
        rows.append(f"select '{name}' as feature_set, {len(xs)}::int as n_features, count(({z}) + y) as n_test, count(*) - count(({z}) + y) as n_not_scored, {rd(f'avg((({z} > 0)::int = y)::int)')} as accuracy from te, {last}")
    return f"with d as {FLAG_SQL}, tr as (select * from d where {where_train}), te as (select * from d where not ({where_train})), " + ", ".join(chains) + " " + " union all ".join(rows)


TIME_SETS = {"all_features": FLAG_XS, "two_features": FLAG_XS[:2]}


@analysis("X10 R2 M7", _two_sets("l_shipdate < timestamp '2000-01-01 00:00:00'", TIME_SETS))
def time_holdout_feature_sets(spark, folder):
    """Trained on the past, tested on the rest: all features against two."""
    rows = splits.split_where(flag_rows(spark, folder), F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return rounded(evaluation.compare_feature_sets(rows, "y", TIME_SETS))


_part_of_key = f"({hash32('l_orderkey', 1515)} < 3006477107)"


@analysis(
    "L10 R1",
    _two_sets("train", {"original": FLAG_XS, "components": FLAG_XS}).replace(f"with d as {FLAG_SQL}", f"with d as {FLAG_SQL.replace('l_shipdate from', f'{_part_of_key} as train from')}"),
)
def raw_against_components(spark, folder):
    """All components span what the features span, so the same classifier must do equally well."""
    rows = splits.train_test_split(flag_rows(spark, folder), "l_orderkey", 0.7, 1515)
    return rounded(evaluation.compare_raw_and_components(rows, "y", FLAG_XS))
