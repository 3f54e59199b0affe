"""Projection and schema operations that need more than a plain DataFrame call."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = WHOLE_NUMBERS + (T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMBERS)]


def split_target(df: DataFrame, is_target: Callable[[str], bool]) -> tuple[DataFrame, DataFrame]:
    """The columns whose name satisfies the predicate, and the others."""
    chosen = [c for c in df.columns if is_target(c)]
    return df.select(*chosen), df.drop(*chosen)


def interaction(df: DataFrame, a: str, b: str, name: str = "interaction") -> DataFrame:
    return df.withColumn(name, F.col(a) * F.col(b))


def with_intercept(df: DataFrame, name: str = "constant") -> DataFrame:
    return df.select(F.lit(1.0).alias(name), "*")


def powers(df: DataFrame, col: str, k: int, prefix: str = "x") -> DataFrame:
    """Add the powers 1..k of one column as ``prefix1`` .. ``prefixk``."""
    return df.select("*", *[F.pow(F.col(col).cast("double"), F.lit(float(i))).alias(f"{prefix}{i}") for i in range(1, k + 1)])


def poly_feature_names(cols: Sequence[str], k: int) -> list[str]:
    return [f"{c}_{d}" for c in cols for d in range(1, k + 1)]


def poly_features(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = ()) -> DataFrame:
    """The powers 1..k of every column, named ``column_degree``, in one projection."""
    made = [F.pow(F.col(c).cast("double"), F.lit(float(d))).alias(f"{c}_{d}") for c in cols for d in range(1, k + 1)]
    return df.select(*keep, *made)


def residuals(df: DataFrame, predicted: str, actual: str, name: str = "residual") -> DataFrame:
    """Predicted minus actual."""
    return df.withColumn(name, F.col(predicted) - F.col(actual))


def level_index(col: str, levels: Sequence) -> Column:
    """Position of a value in an ordered list of levels, from 0; null when it is not a level."""
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(col))
    return F.when(place > 0, (place - 1).cast("int"))


def coerce(df: DataFrame, spec: Mapping[str, str | Sequence]) -> DataFrame:
    """Reinterpret columns: ``continuous``, ``count``, or a list of ordered levels."""
    made = []
    for c in df.columns:
        rule = spec.get(c)
        if rule is None:
            made.append(F.col(c))
        elif rule == "continuous":
            made.append(F.col(c).cast("double").alias(c))
        elif rule == "count":
            made.append(F.col(c).cast("bigint").alias(c))
        else:
            made.append(level_index(c, rule).alias(c))
    return df.select(*made)


def discrete_to_continuous(df: DataFrame) -> DataFrame:
    """Every whole-number column as double."""
    whole = {f.name: "continuous" for f in df.schema.fields if isinstance(f.dataType, WHOLE_NUMBERS)}
    return coerce(df, whole)


def schema_table(df: DataFrame) -> DataFrame:
    """Position, name and type of each column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def to_vector(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    """Several numeric columns as one array of doubles."""
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in cols]))


def take_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in the index set."""
    return df.join(ids.select(key), key, "left_semi")


def drop_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in the index set."""
    return df.join(ids.select(key), key, "left_anti")


def align(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Put predictions beside the truth, by key where the other side has it too."""
    return truth.join(predicted, key, "inner")
