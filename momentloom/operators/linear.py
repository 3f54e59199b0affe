"""Linear models solved from moments: OLS, ridge, polynomials, standardising, components.

The cluster forms the sums of products; the solve is a d x d problem on the driver. Predictions
are plain column expressions, so scoring a table is a projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from numpy.polynomial import legendre, polynomial
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.functions import arrays
from momentloom.functions.scalars import round_significant
from momentloom.operators.moments import Moments, collect_moments

RANK_TOLERANCE = 1e-12
# Above this R2 the error from moments has lost its digits and is measured on the rows instead.
NEARLY_EXACT = 1.0 - 1e-8


@dataclass(frozen=True)
class LinearModel:
    target: str
    features: tuple[str, ...]
    coefs: tuple[float, ...]
    intercept: float
    rank: int

    def expression(self) -> Column:
        value = F.lit(self.intercept)
        for name, b in zip(self.features, self.coefs):
            value = value + F.lit(b) * F.col(name)
        return value

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.expression())


def _solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """Minimum-norm solution of a symmetric system, on the scale of its diagonal."""
    if a.shape[0] == 0:
        return np.zeros(0), 0
    diagonal = np.diag(a).copy()
    scale = np.where(diagonal > 0, np.sqrt(np.maximum(diagonal, 0)), 1.0)
    scaled = a / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(scaled)
    kept = values > RANK_TOLERANCE * max(values.max(), 0.0) * len(values)
    inverse = np.where(kept, 1.0 / np.where(kept, values, 1.0), 0.0)
    solution = vectors @ (inverse * (vectors.T @ (b / scale)))
    return solution / scale, int(kept.sum())


def _constant(scatter: np.ndarray, m: Moments) -> np.ndarray:
    """Columns whose spread is nothing but rounding."""
    size = np.abs(np.diag(m.cross)) + m.n * m.shift**2
    return np.diag(scatter) <= 1e-14 * np.maximum(size, 1e-300)


def solve_linear(
    m: Moments, y: str, xs: Sequence[str], lam: float = 0.0, scale_by_n: bool = True, standardized: bool = False
) -> LinearModel:
    """Least squares with intercept, and a penalty ``lam`` on the squared coefficients.

    The penalty is multiplied by the row count when ``scale_by_n`` is set; the intercept has none.
    With ``standardized`` it falls on the coefficients of the standardised features; the model is
    still written for the features as they are.
    """
    at, t = m.index(xs), m.cols.index(y)
    s = m.scatter()
    flat = _constant(s, m)[at]
    a = s[np.ix_(at, at)].copy()
    b = s[at, t].copy()
    a[flat, :] = a[:, flat] = 0.0
    b[flat] = 0.0
    unit = np.diag(s)[at] / max(m.n - 1, 1) if standardized else np.ones(len(at))
    a += np.diag(np.where(flat & standardized, 0.0, unit) * lam * (m.n if scale_by_n else 1.0))
    coefs, rank = _solve(a, b)
    means = m.mean()
    intercept = float(means[t] - coefs @ means[at])
    return LinearModel(y, tuple(xs), tuple(float(c) for c in coefs), intercept, rank)


def solve_without_intercept(m: Moments, y: str, xs: Sequence[str]) -> LinearModel:
    """Normal equations on the columns as they are; a constant column plays the intercept."""
    at, t = m.index(xs), m.cols.index(y)
    raw = m.raw()
    coefs, rank = _solve(raw[np.ix_(at, at)], raw[at, t])
    return LinearModel(y, tuple(xs), tuple(float(c) for c in coefs), 0.0, rank)


def squared_error(m: Moments, model: LinearModel) -> float:
    """Sum of squared errors of a model on the rows behind ``m``, without seeing them."""
    at, t = m.index(model.features), m.cols.index(model.target)
    b = np.array(model.coefs)
    mean = m.sums / m.n
    s = m.scatter()
    spread = s[t, t] - 2 * b @ s[at, t] + b @ s[np.ix_(at, at)] @ b
    # Mean error in shifted units: the intercept moves by what the shifts contribute.
    constant = model.intercept + b @ m.shift[at] - m.shift[t]
    bias = mean[t] - b @ mean[at] - constant
    return float(max(spread, 0.0) + m.n * bias * bias)


def r2_of(m: Moments, model: LinearModel) -> float | None:
    total = m.scatter()[m.cols.index(model.target), m.cols.index(model.target)]
    return None if total <= 0 else 1.0 - squared_error(m, model) / float(total)


def r2_checked(df: DataFrame, m: Moments, model: LinearModel) -> float | None:
    """R2 from moments, or from a pass over the residuals where the fit is nearly exact."""
    value = r2_of(m, model)
    if value is None or value < NEARLY_EXACT:
        return value
    at = F.col(model.target).cast("double")
    error = F.sum(F.pow(at - model.expression(), F.lit(2.0)))
    complete = df.dropna(subset=[model.target, *model.features])
    row = complete.agg(error.alias("sse"), (F.var_pop(at) * F.count(at)).alias("sst")).first()
    return 1.0 - row["sse"] / row["sst"]


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> LinearModel:
    """Least squares on the given columns only; add a constant column for an intercept."""
    return solve_without_intercept(collect_moments(df, [*xs, y]).total(), y, xs)


def linear_regression(df: DataFrame, y: str, xs: Sequence[str]) -> LinearModel:
    return solve_linear(collect_moments(df, [*xs, y]).total(), y, xs)


def ridge(df: DataFrame, y: str, xs: Sequence[str], lam: float, scale_by_n: bool = True) -> LinearModel:
    return solve_linear(collect_moments(df, [*xs, y]).total(), y, xs, lam, scale_by_n)


def coef_table(spark: SparkSession, model: LinearModel, digits: int | None = None) -> DataFrame:
    """The coefficients as rows ``(term, value)``, the intercept last."""
    rows = [*zip(model.features, model.coefs), ("Intercept", model.intercept)]
    table = spark.createDataFrame(rows, "term string, value double")
    return table if digits is None else table.select("term", round_significant("value", digits).alias("value"))


# Polynomials --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Interval:
    """Maps a column onto [-1, 1], where Legendre polynomials are well conditioned."""

    col: str
    middle: float
    half: float

    def scaled(self) -> Column:
        return (F.col(self.col).cast("double") - F.lit(self.middle)) / F.lit(self.half)


def extent(df: DataFrame, col: str) -> Interval:
    row = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if row[0] is None:
        raise ValueError(f"{col} has no values")
    half = (row[1] - row[0]) / 2
    return Interval(col, (row[0] + row[1]) / 2, half if half > 0 else 1.0)


def legendre_columns(df: DataFrame, interval: Interval, k: int, keep: Sequence[str] = (), prefix: str = "P") -> DataFrame:
    """The Legendre polynomials 1..k of a column. They span what its powers 1..k span.

    The recurrence is laid out one projection per degree, so each value is computed once.
    """
    out = df.select(*keep, interval.scaled().alias(f"{prefix}1"))
    for j in range(2, k + 1):
        t, last = F.col(f"{prefix}1"), F.col(f"{prefix}{j - 1}")
        before = F.col(f"{prefix}{j - 2}") if j > 2 else F.lit(1.0)
        out = out.withColumn(f"{prefix}{j}", (F.lit(2.0 * j - 1) * t * last - F.lit(j - 1.0) * before) / F.lit(float(j)))
    return out


def power_model(model: LinearModel, interval: Interval) -> LinearModel:
    """Rewrite a model on Legendre columns as one on powers of the original column."""
    series = polynomial.Polynomial(legendre.leg2poly([model.intercept, *model.coefs]))
    inner = polynomial.Polynomial([-interval.middle / interval.half, 1.0 / interval.half])
    coefs = np.zeros(len(model.coefs) + 1)
    composed = series(inner).coef
    coefs[: len(composed)] = composed
    names = tuple(f"{interval.col}_{d}" for d in range(1, len(coefs)))
    return LinearModel(model.target, names, tuple(float(c) for c in coefs[1:]), float(coefs[0]), model.rank)


def polyfit(df: DataFrame, x: str, y: str, degree: int) -> tuple[LinearModel, Interval]:
    """Polynomial regression on the scaled basis."""
    interval = extent(df, x)
    names = [f"P{j}" for j in range(1, degree + 1)]
    basis = legendre_columns(df, interval, degree, keep=[y])
    return solve_linear(collect_moments(basis, [*names, y]).total(), y, names), interval


# Standardising and components ---------------------------------------------------------------

@dataclass(frozen=True)
class Standardizer:
    """Means and sample deviations of the rows it was fitted on."""

    cols: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def column(self, name: str) -> Column:
        i = self.cols.index(name)
        if self.deviations[i] == 0:
            return F.when(F.col(name).isNotNull(), F.lit(0.0))
        return (F.col(name).cast("double") - F.lit(self.means[i])) / F.lit(self.deviations[i])

    def apply(self, df: DataFrame) -> DataFrame:
        chosen = set(self.cols)
        return df.select(*[self.column(c).alias(c) if c in chosen else F.col(c) for c in df.columns])

    def only(self, names: Sequence[str]) -> Standardizer:
        """Select first, standardise afterwards: the same numbers for fewer columns."""
        at = [self.cols.index(n) for n in names]
        return Standardizer(tuple(names), tuple(self.means[i] for i in at), tuple(self.deviations[i] for i in at))


def standardize_fit(df: DataFrame, cols: Sequence[str]) -> Standardizer:
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    means = tuple(float(row[f"m{i}"] or 0.0) for i in range(len(cols)))
    return Standardizer(tuple(cols), means, tuple(float(row[f"s{i}"] or 0.0) for i in range(len(cols))))


def standardizer_from(m: Moments, cols: Sequence[str]) -> Standardizer:
    at = m.index(cols)
    spread = np.diag(m.scatter())[at]
    flat = _constant(m.scatter(), m)[at]
    deviations = np.where(flat, 0.0, np.sqrt(np.maximum(spread, 0.0) / max(m.n - 1, 1)))
    return Standardizer(tuple(cols), tuple(map(float, m.mean()[at])), tuple(map(float, deviations)))


@dataclass(frozen=True)
class Components:
    """Principal components of standardised columns, in falling order of variance."""

    standardizer: Standardizer
    variances: tuple[float, ...]
    total_variance: float
    loadings: np.ndarray

    def ratios(self) -> np.ndarray:
        return np.cumsum(self.variances) / self.total_variance

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i + 1, float(v), float(v / self.total_variance)) for i, v in enumerate(self.variances)]
        return spark.createDataFrame(rows, "component int, variance double, ratio double")

    def loading_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (k + 1, c, float(self.loadings[j, k]))
            for k in range(self.loadings.shape[1])
            for j, c in enumerate(self.standardizer.cols)
        ]
        return spark.createDataFrame(rows, "component int, variable string, loading double")

    def transform(self, df: DataFrame, keep: Sequence[str] = (), prefix: str = "pc") -> DataFrame:
        """The projections as columns ``pc1``, ``pc2``, ... beside the kept columns, each row projected once."""
        name = "_projected"
        while name in keep:
            name += "_"
        made = [F.col(name)[k].alias(f"{prefix}{k + 1}") for k in range(self.loadings.shape[1])]
        return df.select(*keep, self.projection().alias(name)).select(*keep, *made)

    def projection(self) -> Column:
        """All projections of a row as one array, by one matrix product per Arrow batch; null where a column is null."""
        return arrays.product(F.array(*[self.standardizer.column(c) for c in self.standardizer.cols]), self.loadings)


def components_from(m: Moments, cols: Sequence[str], variance_ratio: float = 1.0) -> Components:
    """Solve the components of a set of columns from their moments.

    The smallest number of components whose share reaches ``variance_ratio`` is kept. Each vector's
    sign makes its largest loading positive, the first of equals.
    """
    standardizer = standardizer_from(m, cols)
    at = m.index(cols)
    d = np.array(standardizer.deviations)
    safe = np.where(d > 0, d, 1.0)
    covariance = m.scatter()[np.ix_(at, at)] / max(m.n - 1, 1) / np.outer(safe, safe)
    covariance[d == 0, :] = covariance[:, d == 0] = 0.0
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    total = float(values.sum())
    if total <= 0:
        raise ValueError("no column varies")
    share = np.cumsum(values) / total
    kept = len(values) if variance_ratio >= 1 else int(np.argmax(share >= variance_ratio - 1e-12)) + 1
    vectors = vectors[:, :kept].copy()
    for k in range(kept):
        size = np.abs(vectors[:, k])
        lead = int(np.argmax(size >= size.max() - 1e-9))
        if vectors[lead, k] < 0:
            vectors[:, k] = -vectors[:, k]
    return Components(standardizer, tuple(map(float, values[:kept])), total, vectors)


def pca_fit(df: DataFrame, cols: Sequence[str], variance_ratio: float = 1.0) -> Components:
    return components_from(collect_moments(df, cols).total(), cols, variance_ratio)
