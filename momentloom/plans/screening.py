"""Feature screening and model searches answered from one pass of moments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.operators import linear
from momentloom.operators.linear import LinearModel
from momentloom.operators.moments import GroupedMoments, Moments, collect_moments, means


def _number(name: str) -> Column:
    """A column as doubles, null where it is NaN: screens count NaN as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def screen_univariate(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """R2 of the target on each feature alone, from one aggregate over all features.

    Null and NaN are missing: each feature uses the rows where it and the target are known.
    """
    target = _number(y)
    row = df.agg(*[F.regr_r2(target, _number(x)).alias(f"r{i}") for i, x in enumerate(xs)])
    each = [F.struct(F.lit(x).alias("feature"), F.col(f"r{i}").alias("r2")) for i, x in enumerate(xs)]
    return row.select(F.inline(F.array(*each)))


def screen_univariate_star(fact: DataFrame, fact_key: str, y: str, fact_xs: Sequence[str], dim: DataFrame, dim_key: str, dim_xs: Sequence[str]) -> DataFrame:
    """The same screen over a fact table and the features of a table it refers to by a unique key.

    Every feature uses the rows where it and the target are known, as in ``screen_univariate`` over the
    left join; NaN is missing. The target is summed per key before the join, so a hot key is one row in it, and adaptive
    execution broadcasts a small side. Features of the fact table need no join.
    """
    target = _number(y)
    direct = [F.regr_r2(target, _number(x)).alias(f"r{i}") for i, x in enumerate(fact_xs)]
    seen = fact.agg(F.avg(target).alias("m"), *direct).first()
    rows = [(x, seen[f"r{i}"]) for i, x in enumerate(fact_xs)]
    if dim_xs:
        # Sums about the means keep their digits; the means came with the scan above and from the small side.
        moved = fact.select(F.col(fact_key).alias("_key"), (target - F.lit(seen["m"] or 0.0)).alias("_y")).where(F.col("_y").isNotNull())
        per_key = moved.groupBy("_key").agg(F.count("_y").cast("double").alias("n"), F.sum("_y").alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("q"))
        centers = means(dim, dim_xs)
        features = dim.select(F.col(dim_key).alias("_key"), *[(_number(x) - F.lit(float(m))).alias(f"_x{i}") for i, (x, m) in enumerate(zip(dim_xs, centers))])
        sums = []
        for i in range(len(dim_xs)):
            x = F.col(f"_x{i}")
            known = lambda c: F.sum(F.when(F.col(f"_x{i}").isNotNull(), c))
            values = {"n": F.col("n"), "y": F.col("s"), "yy": F.col("q"), "x": F.col("n") * x, "xx": F.col("n") * x * x, "xy": F.col("s") * x}
            sums += [known(v).alias(f"{name}{i}") for name, v in values.items()]
        row = per_key.join(features, "_key").agg(*sums).first()
        rows += [(x, _r2_of_sums(*[row[f"{name}{i}"] for name in ("n", "y", "yy", "x", "xx", "xy")])) for i, x in enumerate(dim_xs)]
    return fact.sparkSession.createDataFrame(rows, "feature string, r2 double")


def _r2_of_sums(n, y, yy, x, xx, xy) -> float | None:
    """The squared correlation from a count and sums; null where either side does not vary."""
    if not n:
        return None
    of_y, of_x = yy - y * y / n, xx - x * x / n
    return (xy - x * y / n) ** 2 / (of_y * of_x) if of_y > 0 and of_x > 0 else None


def drop_one_sets(xs: Sequence[str]) -> list[tuple[str, ...]]:
    """No feature dropped, then each one alone."""
    return [(), *[(x,) for x in xs]]


def screen_drop(df: DataFrame, y: str, xs: Sequence[str], sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """In-sample R2 without each set of features; the full model is the empty set.

    One scan; every candidate is solved from the same sums.
    """
    m = collect_moments(df, [*xs, y]).total()
    rows = []
    for dropped in drop_one_sets(xs) if sets is None else sets:
        kept = [x for x in xs if x not in dropped]
        model = linear.solve_linear(m, y, kept)
        rows.append(("+".join(dropped), len(kept), linear.r2_checked(df, m, model)))
    return df.sparkSession.createDataFrame(rows, "dropped string, n_features int, r2 double")


@dataclass(frozen=True)
class Search:
    """The outcome of a search: a row per candidate, a row per candidate and fold, the winner."""

    spark: SparkSession
    candidates: list[tuple]
    folds: list[tuple]
    best_index: int
    best_model: LinearModel
    fold_type: str = "int"

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.candidates, "candidate int, n_features int, lam double, rms double")

    def fold_table(self) -> DataFrame:
        return self.spark.createDataFrame(self.folds, f"candidate int, fold {self.fold_type}, n bigint, rms double")

    def winner(self) -> DataFrame:
        """The features of the winner, its penalty, and its mean squared error over the held-out rows."""
        _, n, lam, rms = self.candidates[self.best_index]
        row = ("+".join(self.best_model.features), n, lam, rms * rms)
        return self.spark.createDataFrame([row], "features string, n_features int, lam double, mse double")

    def best_folds(self) -> DataFrame:
        return self.fold_table().where(F.col("candidate") == self.best_index)


def search_linear(
    df: DataFrame,
    y: str,
    cases: Sequence[Sequence[str]],
    fold: str,
    lams: Sequence[float] = (0.0,),
    standardized: bool = False,
) -> Search:
    """Cross-validate every feature set with every penalty; the winner is refitted on all rows.

    One scan with one group per fold. The training sums of a fold are the total minus that fold,
    and its error follows from the fold's own sums, so no candidate reads the data again. The
    score is the root of the mean squared error over all held-out rows; ties go to the first. Errors of
    nearly exact fits, which sums cannot resolve, are summed over the rows in one more scan. Rows
    without a fold are left out; a fold without a complete row is an error.
    """
    xs = list(dict.fromkeys(x for case in cases for x in case))
    grouped = collect_moments(df, [*xs, y], by=fold)
    return _search(df, fold, grouped, y, cases, lams, standardized)


def _row_errors(df: DataFrame, fits: Sequence[tuple[Column, LinearModel]]) -> list[float]:
    """Sums of squared errors over the rows, each under its condition; one aggregate for all."""
    made = []
    for i, (rows, model) in enumerate(fits):
        error = F.col(model.target).cast("double") - model.expression()
        made.append(F.sum(F.when(rows, error * error)).alias(f"e{i}"))
    return [float(v or 0.0) for v in df.agg(*made).first()]


#: Share of the target's squares under which an error from sums has lost its digits.
UNRESOLVED = 1e-8


def _search(df: DataFrame, fold: str, grouped: GroupedMoments, y, cases, lams, standardized) -> Search:
    groups = {g: m for g, m in grouped.groups.items() if g is not None}
    names = sorted(groups)
    if len(names) < 2:
        raise ValueError("cross-validation needs at least two folds")
    empty = [g for g in names if groups[g].n == 0]
    if empty:
        raise ValueError(f"folds without a complete row: {empty}")
    total = GroupedMoments(groups).total()
    train = {g: total - groups[g] for g in names}
    fits, errors = [], []
    for case in cases:
        for lam in lams:
            for g in names:
                model = linear.solve_linear(train[g], y, case, lam, standardized=standardized)
                fits.append((g, model))
                errors.append(linear.squared_error(groups[g], model))
    at = total.cols.index(y)
    limit = {g: UNRESOLVED * float(groups[g].raw()[at, at]) for g in names}
    poor = [i for i, (g, _) in enumerate(fits) if errors[i] <= limit[g]]
    if poor:
        complete = df.dropna(subset=list(total.cols))
        for i, value in zip(poor, _row_errors(complete, [(F.col(fold) == F.lit(fits[i][0]), fits[i][1]) for i in poor])):
            errors[i] = value
    candidates, folds, k = [], [], len(names)
    for case in cases:
        for lam in lams:
            number = len(candidates)
            mine = errors[number * k : (number + 1) * k]
            folds += [(number, g, int(groups[g].n), float((e / groups[g].n) ** 0.5)) for g, e in zip(names, mine)]
            candidates.append((number, len(case), float(lam), float((sum(mine) / total.n) ** 0.5)))
    best = min(candidates, key=lambda r: (r[3], r[0]))[0]
    case, lam = cases[best // len(lams)], lams[best % len(lams)]
    winner = linear.solve_linear(total, y, case, lam, standardized=standardized)
    return Search(df.sparkSession, candidates, folds, best, winner, dict(df.dtypes)[fold])


def prefixes(xs: Sequence[str], limit: int | None = None) -> list[list[str]]:
    """The first feature, the first two, and so on."""
    return [list(xs[:i]) for i in range(1, (limit or len(xs)) + 1)]


def search_polynomial(df: DataFrame, x: str, y: str, degrees: int, fold: str) -> Search:
    """Cross-validate polynomials of degree 1 to ``degrees`` on a well-conditioned basis."""
    interval = linear.extent(df, x)
    basis = linear.legendre_columns(df, interval, degrees, keep=[fold, y])
    return search_linear(basis, y, prefixes([f"P{j}" for j in range(1, degrees + 1)]), fold)


def holdout_errors(df: DataFrame, y: str, cases: Mapping[str, Sequence[str]], split: str = "split") -> DataFrame:
    """Fit each case on the train rows; mean squared errors on both parts, from one scan.

    Errors of nearly exact fits take one more scan, as in ``search_linear``.
    """
    xs = list(dict.fromkeys(x for case in cases.values() for x in case))
    parts = collect_moments(df, [*xs, y], by=split).groups
    both = ("train", "test")
    models = {name: linear.solve_linear(parts["train"], y, case) for name, case in cases.items()}
    errors = {(name, p): linear.squared_error(parts[p], model) for name, model in models.items() for p in both}
    at = parts["train"].cols.index(y)
    poor = [key for key, e in errors.items() if e <= UNRESOLVED * float(parts[key[1]].raw()[at, at])]
    if poor:
        complete = df.dropna(subset=[*xs, y])
        errors |= zip(poor, _row_errors(complete, [(F.col(split) == p, models[name]) for name, p in poor]))
    rows = [(name, len(case), *[float(errors[name, p] / parts[p].n) for p in both]) for name, case in cases.items()]
    return df.sparkSession.createDataFrame(rows, "model string, n_features int, train_mse double, test_mse double")
