"""Array-column functions. A matrix is a flat array in column-major order, as the data comes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from momentloom.functions.scalars import column


def doubles(a: Column | str) -> Column:
    return column(a).cast("array<double>")


def add_scalar(a: Column | str, value: Column | float) -> Column:
    value = value if isinstance(value, Column) else F.lit(float(value))
    return F.transform(doubles(a), lambda x: x + value)


def scale(a: Column | str, divisor: float) -> Column:
    return F.transform(doubles(a), lambda x: x / F.lit(float(divisor)))


def multiply(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)


def total(a: Column | str) -> Column:
    return F.aggregate(doubles(a), F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column | str) -> Column:
    return F.try_divide(total(a), F.size(column(a)))


def cell(a: Column | str, row: int, col: int, rows: int) -> Column:
    """Entry (row, col), both counted from 1."""
    return F.element_at(column(a), row + (col - 1) * rows)


def matrix_row(a: Column | str, row: int, rows: int, cols: int) -> Column:
    return F.array(*[cell(a, row, c, rows) for c in range(1, cols + 1)])


def matrix_column(a: Column | str, col: int, rows: int) -> Column:
    return F.slice(column(a), 1 + (col - 1) * rows, rows)


def block(a: Column | str, rows_wanted: Sequence[int], cols_wanted: Sequence[int], rows: int) -> Column:
    """The chosen rows and columns, flat and column-major again."""
    return F.array(*[cell(a, r, c, rows) for c in cols_wanted for r in rows_wanted])


def _regroup(a: Column | str, positions: Sequence[int]) -> Column:
    """Pick entries by zero-based position, in the given order."""
    a = column(a)
    wanted = F.array(*[F.lit(p + 1) for p in positions])
    return F.transform(wanted, lambda p: F.element_at(a, p))


def transpose(a: Column | str, rows: int, cols: int) -> Column:
    return _regroup(a, [r + c * rows for r in range(rows) for c in range(cols)])


def flip_rows(a: Column | str, rows: int, cols: int) -> Column:
    """The matrix upside down."""
    return _regroup(a, [(rows - 1 - r) + c * rows for c in range(cols) for r in range(rows)])


def upright(a: Column | str, rows: int, cols: int) -> Column:
    """Transpose, then turn upside down: a scanned image becomes a picture to draw."""
    # After the transpose the matrix has ``cols`` rows, and its entry (i, j) is entry (j, i) here.
    return _regroup(a, [j + (cols - 1 - i) * rows for j in range(rows) for i in range(cols)])


def pool(a: Column | str, rows: int, cols: int, window: int = 2, how: str = "mean") -> Column:
    """Shrink the matrix by ``window`` in both directions with the mean or the maximum."""
    a = column(a)
    cells = []
    for c in range(0, cols - window + 1, window):
        for r in range(0, rows - window + 1, window):
            places = [r + i + (c + j) * rows + 1 for j in range(window) for i in range(window)]
            parts = [F.element_at(a, p).cast("double") for p in places]
            if how == "max":
                cells.append(F.greatest(*parts))
            elif how == "mean":
                cells.append(sum(parts[1:], parts[0]) / F.lit(float(window * window)))
            else:
                raise ValueError("how must be 'mean' or 'max'")
    return F.array(*cells)


def one_hot(label: Column | str, classes: Sequence) -> Column:
    label = column(label)
    return F.array(*[F.when(label == F.lit(k), F.lit(1)).otherwise(F.lit(0)) for k in classes])


def argmax(a: Column | str) -> Column:
    """Position of the largest entry from 1; the first one on ties."""
    return bind(column(a), lambda v: F.array_position(v, F.array_max(v)).cast("int"))


def decode(a: Column | str, classes: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in classes]), argmax(a))


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, also where lambdas nest."""
    return F.transform(F.array(value), body)[0]


def _exponentials(a: Column | str) -> Column:
    """The largest entry and the exponentials of the distances to it."""
    with_top = F.struct(doubles(a).alias("v"), F.array_max(doubles(a)).alias("top"))
    return bind(
        with_top,
        lambda s: F.struct(F.transform(s["v"], lambda x: F.exp(x - s["top"])).alias("e"), s["top"].alias("top")),
    )


def softmax(a: Column | str) -> Column:
    return bind(
        bind(_exponentials(a), lambda s: F.struct(s["e"].alias("e"), total(s["e"]).alias("t"))),
        lambda s: F.transform(s["e"], lambda x: x / s["t"]),
    )


def log_sum_exp(a: Column | str) -> Column:
    return bind(_exponentials(a), lambda s: s["top"] + F.log(total(s["e"])))


def dense(a: Column | str, weights, bias, activation: str | None = None) -> Column:
    """One fully connected layer as one matrix product per Arrow batch. ``weights`` has one row per output.

    A null array gives null, as does one of another length than the weights ask for; a null or NaN element makes
    every output null.
    """
    weights = np.asarray(weights, dtype=float)
    bias = np.asarray(bias, dtype=float)
    if activation not in (None, "relu", "sigmoid"):
        raise ValueError(f"unknown activation {activation!r}")

    @F.pandas_udf("array<double>")
    def score(batch: pd.Series) -> pd.Series:
        known = np.array([x is not None and len(x) == weights.shape[1] for x in batch], dtype=bool)
        out = pd.Series([None] * len(batch), dtype=object)
        if known.any():
            z = np.stack([np.asarray(x, dtype=float) for x in batch[known]]) @ weights.T + bias
            if activation == "relu":
                z = np.maximum(z, 0.0)
            elif activation == "sigmoid":
                z = 1.0 / (1.0 + np.exp(-z))
            out[known] = pd.Series(list(z), index=np.flatnonzero(known))
        return out

    return score(doubles(a))


def product(a: Column | str, weights) -> Column:
    """The row vector ``a`` times a matrix with one row per element, as one matrix product per Arrow batch.

    Null for a null array, for one of another length and for one with a null element; NaN spreads as in arithmetic.
    The plan has one expression, whatever the size of the matrix.
    """
    weights = np.ascontiguousarray(weights, dtype=float)
    height, width = weights.shape

    @F.arrow_udf("array<double>")
    def multiplied(batch: pa.Array) -> pa.Array:
        fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(batch), height), False))
        cells = batch.filter(pa.array(fits)).flatten()
        known = ~np.asarray(cells.is_null()).reshape(int(fits.sum()), height).any(axis=1)
        x = cells.to_numpy(zero_copy_only=False).reshape(len(known), height)[known].astype(float)
        fits[fits] = known
        ends = np.concatenate([[0], np.cumsum(np.where(fits, width, 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array((x @ weights).ravel()), mask=pa.array(~fits))

    return multiplied(doubles(a))
