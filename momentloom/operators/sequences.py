"""Classifying sequences of points by how they turn, from aggregates over neighbouring points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentloom.operators.ordered import following

SEQUENCE_FEATURES = ("signed_area", "mean_turn", "path_length")


def sequence_features(points: DataFrame, by: str = "seq_id", order: str = "step", x: str = "x", y: str = "y") -> DataFrame:
    """Per sequence: points, twice the signed area, mean turn and path length.

    The area sums ``x y' - x' y`` over neighbours: positive when the path runs anticlockwise. The
    turn is that product over the squared distances from the origin, averaged.
    """
    pairs = following(points, by, order, [x, y])
    cross = F.col(x) * F.col(f"next_{y}") - F.col(f"next_{x}") * F.col(y)
    reach = F.sqrt((F.col(x) * F.col(x) + F.col(y) * F.col(y)) * (F.col(f"next_{x}") * F.col(f"next_{x}") + F.col(f"next_{y}") * F.col(f"next_{y}")))
    leg = F.sqrt(F.pow(F.col(f"next_{x}") - F.col(x), F.lit(2.0)) + F.pow(F.col(f"next_{y}") - F.col(y), F.lit(2.0)))
    return pairs.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.coalesce(F.sum(cross), F.lit(0.0)).alias("signed_area"),
        F.coalesce(F.avg(F.try_divide(cross, reach)), F.lit(0.0)).alias("mean_turn"),
        F.coalesce(F.sum(leg), F.lit(0.0)).alias("path_length"),
    )
