"""Tables: parquet by name, wide CSV, literal rows, grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The named table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_csv_schema(label: str, value_cols: Sequence[str]) -> T.StructType:
    fields = [T.StructField(label, T.IntegerType())]
    return T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in value_cols])


def load_wide_csv(spark: SparkSession, path: str, label: str, value_cols: Sequence[str]) -> DataFrame:
    """A headed CSV of one label and many numeric columns, as ``(label, values array)``.

    The schema is given, so the file is read once; a header that does not fit it is an error.
    """
    schema = wide_csv_schema(label, value_cols)
    raw = spark.read.schema(schema).option("enforceSchema", "false").csv(path, header=True, mode="FAILFAST")
    return raw.select(label, F.array(*[F.col(c) for c in value_cols]).alias("values"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def load_wide_csv_checked(spark: SparkSession, path: str, label: str, value_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """As ``load_wide_csv``, with rows that do not fit told apart: ``(label, values array)`` and ``(bad_record)``.

    A row is bad if it has too few or too many fields or one that is not of its column's type; an empty field is null. The
    good rows keep their places in the array, whatever the number of columns.
    """
    schema = wide_csv_schema(label, value_cols).add("bad_record", T.StringType())
    if spark.read.option("header", True).csv(path).columns != [label, *value_cols]:
        raise ValueError("the header does not list the label and the value columns in order")
    # Lines are parsed as a column: a scan would only parse the columns in use and take broken rows for good ones.
    lines = spark.read.text(path).where((F.trim("value") != "") & (F.replace("value", F.lit('"'), F.lit("")) != ",".join([label, *value_cols])))
    parsed = lines.select(F.from_csv("value", ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema), {"columnNameOfCorruptRecord": "bad_record"}).alias("r"))
    packed = parsed.select(F.col(f"r.{_quoted(label)}"), F.array(*[F.col(f"r.{_quoted(c)}") for c in value_cols]).alias("values"), "r.bad_record")
    good = packed.where(F.col("bad_record").isNull()).drop("bad_record")
    return good, packed.where(F.col("bad_record").isNotNull()).select("bad_record")


def literal_table(spark: SparkSession, columns: Mapping[str, Sequence]) -> DataFrame:
    """A small table written out in the program, column by column."""
    lengths = {len(v) for v in columns.values()}
    if len(lengths) != 1:
        raise ValueError(f"columns differ in length: {sorted(lengths)}")
    return spark.createDataFrame(list(zip(*columns.values())), list(columns))


def param_grid(spark: SparkSession, **axes: Sequence) -> DataFrame:
    """Every combination of the axes' values, numbered in the order they are written.

    The axes are arguments of a search and so of fixed size; they unfold from one row.
    """
    grid = spark.range(1).select()
    for name, values in axes.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    weight, candidate = 1, F.lit(0)
    for name, values in reversed(list(axes.items())):
        place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(name)) - 1
        candidate = candidate + place * weight
        weight *= len(values)
    return grid.select(candidate.cast("int").alias("candidate"), *axes)


def log_scale(low: float, high: float, count: int) -> list[float]:
    """``count`` values from ``low`` to ``high`` with equal ratios."""
    if count == 1:
        return [float(low)]
    ratio = (high / low) ** (1.0 / (count - 1))
    values = [low * ratio**i for i in range(count)]
    values[-1] = float(high)
    return values


def grid(df: DataFrame, col: str, n: int, name: str | None = None) -> DataFrame:
    """``n`` evenly spaced values over the extent of a column, ends included."""
    name = name or col
    extent = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    points = extent.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("step"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("step") / F.lit(float(max(n - 1, 1)))
    return points.select("step", value.alias(name))


def spaced(spark: SparkSession, low: float, high: float, n: int, name: str) -> DataFrame:
    """``n`` evenly spaced values between two given ends."""
    step = F.col("id").cast("int")
    value = F.lit(float(low)) + F.lit(float(high) - float(low)) * F.col("id") / F.lit(float(max(n - 1, 1)))
    return spark.range(n).select(step.alias("step"), value.alias(name))
