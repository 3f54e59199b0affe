"""Connected components, and blocks of a large group that are compared in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, splittable


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``a, b`` (long): root is the least node of its component.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the least of them. Groups are
    only ever reduced to a minimum, and the join that brings it back can be split, so a node with any number of
    neighbours is no burden for one task. Rounds grow
    with the logarithm of the largest component; every round is kept on shared storage. It ends when all edges hang on
    the least node of their component. Nodes without an edge
    to another node are left out, as are edges with a null end.
    """
    pairs = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _are_stars(pairs):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = splittable(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = kept(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = splittable(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = kept(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node u hangs on one node v that hangs on none: as v < u, it is the least of its component."""
    several = pairs.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    inner = pairs.select("u").join(pairs.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return several.union(inner).agg(F.count("*")).first()[0] == 0


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect the same nodes as the pairs (a, b), at most one for each node."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def block_of(key: str, blocks: Column, salt: str) -> Column:
    """A block number below ``blocks``, from a hash of the key."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), blocks)


def whole_groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Groups from batches that are sorted by ``by``, also where a group lies across batches."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[by].to_numpy()
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, len(batch)]):
            part = batch.iloc[start:end]
            if rest and (rest[-1][by].to_numpy()[-1] != keys[start]).any():
                yield pd.concat(rest) if len(rest) > 1 else rest[0]
                rest = []
            rest.append(part)
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]
