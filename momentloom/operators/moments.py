"""Sums of products: the one pass that every linear model, search and component is solved from.

A scan yields, per group, the row count, the column sums and the sums of pairwise products. These
add up: the data without fold 3 is the total minus fold 3. So hundreds of candidate models cost
one scan, and only O(groups x columns^2) numbers reach the driver.

Columns are shifted by their mean before they are multiplied, so that subtracting the mean part
afterwards does not cancel the digits that matter. The means take a scan of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers that may come to the driver: 160 MB.
LIMIT = 20_000_000
# Cells of the matrices that a task holds before it hands them on.
HELD_CELLS = 4_000_000


@dataclass(frozen=True)
class Moments:
    """Count, sums and cross products of shifted columns."""

    cols: tuple[str, ...]
    n: float
    sums: np.ndarray
    cross: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.cols, self.n + other.n, self.sums + other.sums, self.cross + other.cross, self.shift)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.cols, self.n - other.n, self.sums - other.sums, self.cross - other.cross, self.shift)

    def index(self, names: Sequence[str]) -> list[int]:
        return [self.cols.index(c) for c in names]

    def mean(self) -> np.ndarray:
        return self.shift + self.sums / self.n

    def scatter(self) -> np.ndarray:
        """Cross products about the mean."""
        return self.cross - np.outer(self.sums, self.sums) / self.n

    def raw(self) -> np.ndarray:
        """Cross products of the columns as they are."""
        side = np.outer(self.sums, self.shift)
        return self.cross + side + side.T + self.n * np.outer(self.shift, self.shift)


@dataclass(frozen=True)
class GroupedMoments:
    groups: dict

    def total(self) -> Moments:
        return reduce(lambda a, b: a + b, self.groups.values())

    def without(self, group) -> Moments:
        """The moments of all other groups."""
        rest = [m for g, m in self.groups.items() if g != group]
        if not rest:
            raise ValueError("there is only one group")
        return reduce(lambda a, b: a + b, rest)


def means(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """The mean of the finite values of each column, 0 where there are none; one aggregate."""
    number = lambda c: F.col(c).cast("double")
    finite = lambda c: F.when(~F.isnan(number(c)) & (F.abs(number(c)) < float("inf")), number(c))
    row = df.agg(*[F.avg(finite(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return np.array([0.0 if m is None or not np.isfinite(m) else m for m in row])


def collect_moments(df: DataFrame, cols: Sequence[str], by: str | None = None, shift: np.ndarray | None = None, limit: int = LIMIT) -> GroupedMoments:
    """The moments of each group (one group named None without ``by``).

    Rows with a missing value in any of the columns are left out. The sums of all groups come to the
    driver; more than ``limit`` numbers are an error, and ``gram`` keeps them distributed.
    """
    data = df.select(*([by] if by else []), F.array(*[F.col(c).cast("double") for c in cols]).alias("_v"))
    shift = means(df, cols) if shift is None else shift
    groups = _collected(data, "_v", tuple(cols), by, shift, limit)
    if not groups or sum(m.n for m in groups.values()) == 0:
        raise ValueError("there are no complete rows")
    return GroupedMoments(groups)


def collect_vector_moments(df: DataFrame, vector: str, dim: int, by: str | None = None, limit: int = LIMIT) -> GroupedMoments:
    """As ``collect_moments`` for an array column of fixed length; columns are named v1, v2, ..."""
    names = tuple(f"v{i}" for i in range(1, dim + 1))
    group = [by] if by else []
    data = df.select(*group, F.col(vector).cast("array<double>").alias("_v")).where(F.size("_v") == dim)
    center = data.agg(*[F.avg(F.when(~F.isnan(F.col("_v")[i]), F.col("_v")[i])).alias(f"m{i}") for i in range(dim)]).first()
    groups = _collected(data, "_v", names, by, np.array([m or 0.0 for m in center]), limit)
    if not groups:
        raise ValueError("there are no rows")
    return GroupedMoments(groups)


def _collected(data: DataFrame, vector: str, cols: tuple[str, ...], by: str | None, shift: np.ndarray, limit: int) -> dict:
    d = len(cols)
    most = max(1, limit // (d + 1) ** 2) * (d + 1)
    rows = _matrix_rows(data, vector, d, by, shift).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {limit} numbers for the driver: use gram(), which keeps the sums distributed")
    matrices: dict = {}
    for row in rows:
        key = row["g"] if by else None
        matrices.setdefault(key, np.zeros((d + 1, d + 1)))[row["i"]] = row[2:]
    return {k: Moments(cols, float(m[0, 0]), m[0, 1:].copy(), m[1:, 1:].copy(), np.asarray(shift, dtype=float)) for k, m in matrices.items()}


def _matrix_rows(data: DataFrame, vector: str, d: int, by: str | None, shift: np.ndarray) -> DataFrame:
    """Rows ``g, i, c0 .. cd`` of the sum of (1, x)(1, x)' over the complete rows of each group.

    Each task folds its Arrow batches into one matrix per group by BLAS. The matrix holds count, sums and
    products at once. It leaves the task row by row, and the rows of all tasks are summed as an
    ordinary grouped aggregate.
    """
    by_field = [T.StructField("g", data.schema[by].dataType if by else T.IntegerType())]
    fields = by_field + [T.StructField("i", T.IntegerType())] + [T.StructField(f"c{j}", T.DoubleType()) for j in range(d + 1)]
    names = [f.name for f in fields]
    offset = np.asarray(shift, dtype=float)
    most = max(1, HELD_CELLS // (d + 1) ** 2)

    def told(held: dict, kind) -> Iterator:
        for key, matrix in held.items():
            columns = [pa.array([key] * (d + 1), type=kind), pa.array(np.arange(d + 1, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c) for c in np.ascontiguousarray(matrix.T)]], names=names)
        held.clear()

    def fold(batches: Iterator) -> Iterator:
        held: dict = {}
        kind = pa.int32()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d) - offset
            complete = ~np.isnan(x).any(axis=1)  # a null is read as NaN
            x = np.hstack([np.ones((len(x), 1)), x])[complete]
            if by is None:
                held[0] = held.get(0, 0.0) + x.T @ x
                continue
            kind = batch.column(by).type
            keys = batch.column(by).dictionary_encode(null_encoding="encode")
            place = keys.indices.to_numpy(zero_copy_only=False)[complete]
            for code, key in enumerate(keys.dictionary.to_pylist()):
                part = x[place == code]  # a group without a complete row has sums of zero
                held[key] = held.get(key, 0.0) + part.T @ part
            if len(held) > most:
                yield from told(held, kind)
        yield from told(held, kind)

    partial = data.mapInArrow(fold, T.StructType(fields))
    return partial.groupBy("g", "i").agg(*[F.sum(c).alias(c) for c in names[2:]])


def gram(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Products of the columns as a table ``(by, i, j, value)`` with i <= j, kept distributed.

    One matrix per task and group, summed row by row; the products of a group unfold after it.
    """
    d = len(cols)
    data = df.select(*([by] if by else []), F.array(*[F.col(c).cast("double") for c in cols]).alias("_v"))
    rows = _matrix_rows(data, "_v", d, by, np.zeros(d)).where("i > 0")
    names = F.array(*[F.lit(c) for c in cols])
    row = F.array(*[F.col(f"c{j}") for j in range(1, d + 1)])
    cells = rows.select("g", "i", F.posexplode(row).alias("j", "value")).where("j >= i - 1")
    key = [F.col("g").alias(by)] if by else []
    return cells.select(*key, F.element_at(names, F.col("i")).alias("i"), F.element_at(names, F.col("j") + 1).alias("j"), "value")
