"""Column profiles, histograms, value counts, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from momentloom.operators.moments import collect_moments
from momentloom.operators.quantiles import SMALL_REMAINDER, quantiles_beside
from momentloom.operators.schema import numeric_columns

STATISTICS = ("mean", "std", "var", "min", "median", "max", "nmissing", "eltype")
DEFAULT_STATISTICS = ("mean", "min", "median", "max", "nmissing", "eltype")


def _from_one_row(row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One output row per struct of a one-row table."""
    return row.select(F.inline(F.array(*structs)))


def _one_row(df: DataFrame, row: Row, aggregates: Sequence[Column]) -> DataFrame:
    """The aggregates of a collected row as a table of one row again."""
    schema = df.agg(*aggregates).schema
    return df.sparkSession.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)


def describe(df: DataFrame, stats: Sequence[str] = DEFAULT_STATISTICS, approx: bool = False, small: int = SMALL_REMAINDER) -> DataFrame:
    """One row per column with the chosen statistics, from one aggregate over all columns.

    Text columns and times have no mean, deviation or median; their extremes are in ``min_text`` and
    ``max_text``. Medians are exact unless ``approx`` is set: two more scans then count around the guesses of
    the first one and collect the ``small`` rows that remain.
    """
    unknown = set(stats) - set(STATISTICS)
    if unknown:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    numeric = numeric_columns(df)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ordered = [c for c in df.columns if not types[c].startswith(("array", "map", "struct"))]
    exact = "median" in stats and not approx and bool(numeric)
    place = {c: i for i, c in enumerate(df.columns)}
    aggregates, structs = [], []

    def named(i: int, stat: str, value: Column) -> Column:
        aggregates.append(value.alias(f"{stat}_{i}"))
        return F.col(f"{stat}_{i}")

    for c in df.columns:
        i, is_number = place[c], c in numeric
        number = F.col(c).cast("double") if is_number else None
        nothing, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        fields = [F.lit(c).alias("variable")]
        for stat in stats:
            if stat == "eltype":
                fields.append(F.lit(types[c]).alias("eltype"))
            elif stat == "nmissing":
                fields.append(named(i, stat, F.count_if(F.col(c).isNull())).alias(stat))
            elif stat in ("min", "max"):
                pick = F.min if stat == "min" else F.max
                fields.append((named(i, stat, pick(number)) if is_number else nothing).alias(stat))
                has_text = c in ordered and not is_number
                text = named(i, f"{stat}_text", pick(F.col(c)).cast("string")) if has_text else no_text
                fields.append(text.alias(f"{stat}_text"))
            elif not is_number:
                fields.append(nothing.alias(stat))
            elif stat == "median":
                value = F.col(f"median_{i}") if exact else named(i, stat, F.percentile_approx(number, 0.5))
                fields.append(value.alias(stat))
            else:
                maker = {"mean": F.avg, "std": F.stddev_samp, "var": F.var_samp}[stat]
                fields.append(named(i, stat, maker(number)).alias(stat))
        structs.append(F.struct(*fields))
    aggregates = aggregates or [F.count(F.lit(1)).alias("_rows")]
    if not exact:
        return _from_one_row(df.agg(*aggregates), structs)
    medians, row = quantiles_beside(df, numeric, [0.5], aggregates, small=small)
    known = [F.lit(medians[c][0.5]).cast("double").alias(f"median_{place[c]}") for c in numeric]
    return _from_one_row(_one_row(df, row, aggregates).select("*", *known), structs)


def mean_std(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def summary_statistics(df: DataFrame, cols: Sequence[str], approx: bool = False, small: int = SMALL_REMAINDER) -> DataFrame:
    """Count, missing, mean, minimum, quartiles and maximum of each column, in as many scans as ``describe``."""
    quartiles = (0.25, 0.5, 0.75)
    aggregates, structs = [], []
    for i, c in enumerate(cols):
        number = F.col(c).cast("double")
        aggregates += [
            F.count(c).alias(f"n_{i}"),
            F.count_if(F.col(c).isNull()).alias(f"missing_{i}"),
            F.avg(number).alias(f"mean_{i}"),
            F.min(number).alias(f"min_{i}"),
            F.max(number).alias(f"max_{i}"),
        ]
        if approx:
            aggregates.append(F.percentile_approx(number, list(quartiles)).alias(f"q_{i}"))
        q = [F.col(f"q_{i}")[j] for j in range(3)]
        structs.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.col(f"n_{i}").alias("n"),
                F.col(f"missing_{i}").alias("nmissing"),
                F.col(f"mean_{i}").alias("mean"),
                F.col(f"min_{i}").alias("min"),
                q[0].alias("q25"),
                q[1].alias("median"),
                q[2].alias("q75"),
                F.col(f"max_{i}").alias("max"),
            )
        )
    if approx:
        return _from_one_row(df.agg(*aggregates), structs)
    exact, row = quantiles_beside(df, cols, quartiles, aggregates, small=small)
    known = [F.array(*[F.lit(exact[c][p]).cast("double") for p in quartiles]).alias(f"q_{i}") for i, c in enumerate(cols)]
    return _from_one_row(_one_row(df, row, aggregates).select("*", *known), structs)


def left_out(df: DataFrame, col: str) -> DataFrame:
    """How many rows have no place on a histogram: nulls, NaN and infinities."""
    v = F.col(col).cast("double")
    return df.agg(F.count_if(v.isNull()).alias("n_null"), F.count_if(F.isnan(v)).alias("n_nan"), F.count_if(F.abs(v) == float("inf")).alias("n_infinite"))


def histogram(df: DataFrame, col: str, bins: int, normalize: bool = False) -> DataFrame:
    """Counts in equal-width bins over the extent, empty bins included.

    Nulls, NaN and infinities have no bin; ``left_out`` counts them. With ``normalize`` there is a density whose integral is one. One scan finds the extent, one
    counts the bins with map-side combining.
    """
    data = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    ends = data.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, size = ends["lo"], ends["n"]
    width = None if lo is None else (ends["hi"] - lo) / bins
    low, step = F.lit(lo).cast("double"), F.lit(width).cast("double")
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - low, step)), F.lit(0))
    counts = data.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = every_bin.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    edges = filled.select("bin", (low + F.col("bin") * step).alias("low"), (low + (F.col("bin") + 1) * step).alias("high"), "n")
    if not normalize:
        return edges
    return edges.withColumn("density", F.try_divide(F.col("n").cast("double"), F.lit(float(size)) * step))


def countmap(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def levels(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column in lexicographic order."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as rows ``(i, j, col_i, col_j, r)``.

    One pass over the data whatever the number of pairs. A column that does not vary has no
    correlation: null.
    """
    s = collect_moments(df, cols).total().scatter()
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            spread = s[i, i] * s[j, j]
            r = None if spread <= 0 else 1.0 if i == j else float(s[i, j] / spread**0.5)
            rows.append((i + 1, j + 1, a, b, r))
    return df.sparkSession.createDataFrame(rows, "i int, j int, col_i string, col_j string, r double")


def upper_triangle(matrix: DataFrame) -> DataFrame:
    """The entries on and above the diagonal of a long matrix."""
    return matrix.where(F.col("i") <= F.col("j"))
