"""Generated rows. Every number is a function of the row's key and the seed.

Each function takes a table and the name of its unique key, so the generated data grows with the
table; ``spark.range(n)`` gives a table of n keys where none exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentloom.functions.scalars import gumbel_from_uniform, seeded_normal, seeded_uniform


def uniform(keys: DataFrame, key: str, width: int, seed: int) -> DataFrame:
    """``width`` uniforms per key as an array."""
    draws = F.array(*[seeded_uniform(key, f"{seed}.{j}") for j in range(width)])
    return keys.select(key, draws.alias("u"))


def digits(keys: DataFrame, key: str, seed: int, classes: int = 10) -> DataFrame:
    """One of 0..classes-1 per key, each equally likely."""
    return keys.select(key, F.floor(seeded_uniform(key, seed) * classes).cast("int").alias("digit"))


def gumbel(keys: DataFrame, key: str, seed: int) -> DataFrame:
    """One standard Gumbel draw per key."""
    return keys.select(key, gumbel_from_uniform(seeded_uniform(key, seed)).alias("x"))


def gumbel_grid(indexed: DataFrame, index: str) -> DataFrame:
    """The Gumbel quantiles at (i + 0.5) / n for a dense index 0..n-1: no randomness at all."""
    n = indexed.select(F.count(F.lit(1))).scalar()
    u = (F.col(index) + F.lit(0.5)) / n
    return indexed.select(index, gumbel_from_uniform(u).alias("x"))


def linear(keys: DataFrame, key: str, beta: Sequence[float], sigma: float, seed: int) -> DataFrame:
    """``y = beta[0] + sum beta[j] x_j + noise`` with independent standard normal ``x_j``."""
    xs = [seeded_normal(key, f"{seed}x{j}").alias(f"x{j}") for j in range(1, len(beta))]
    rows = keys.select(key, *xs, (F.lit(float(sigma)) * seeded_normal(key, f"{seed}e")).alias("noise"))
    y = F.lit(float(beta[0]))
    for j, b in enumerate(beta[1:], start=1):
        y = y + F.lit(float(b)) * F.col(f"x{j}")
    return rows.select(key, *[f"x{j}" for j in range(1, len(beta))], (y + F.col("noise")).alias("y"))


def spirals(keys: DataFrame, key: str, length: int, turns: float = 2.0, label=None) -> DataFrame:
    """One Archimedean spiral of ``length`` points per key, turning one way or the other.

    Label 0 turns clockwise and 1 anticlockwise. Without a label column the keys in the lower
    half of the key range get 0. The start angle comes from the key so that spirals differ.
    """
    if label is None:
        middle = keys.select((F.min(key) + F.max(key)) / F.lit(2.0)).scalar()
        label = F.when(F.col(key) < middle, F.lit(0)).otherwise(F.lit(1))
    start = F.lit(6.283185307179586) * seeded_uniform(key, "spiral")
    # The start is hashed once for a key, before its points are laid out.
    starts = keys.select(F.col(key).alias("seq_id"), label.alias("label"), start.alias("start"))
    points = starts.select("*", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("step"))
    radius = (F.col("step") + 1) / F.lit(float(length))
    turn = F.when(F.col("label") == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    angle = F.col("start") + turn * F.lit(6.283185307179586 * turns) * F.col("step") / F.lit(float(length))
    return points.select(
        "seq_id",
        "label",
        "step",
        (radius * F.cos(angle)).alias("x"),
        (radius * F.sin(angle)).alias("y"),
    )
