"""Near-duplicate vectors by lattice hashing.

A vector of unit length is projected on eight random directions for each of ``TABLES`` tables, and the
projection is decoded to the nearest point of the lattice E8, its home cell. A vector also probes the ``PROBES``
lattice points next to its home that lie nearest to its projection. Two vectors meet where one's home is the
home or a probe of the other, and only vectors that meet are compared, by their exact cosine.

The scale of the lattice follows from the threshold and the number of dimensions, so that a pair at the
threshold meets in one table with probability 0.946 (measured on random pairs) and in six with all but 3e-8;
closer pairs meet more often.

A cell of any size is cut into blocks, and pairs of blocks are compared in tasks of bounded size, which give
sums and spanning edges, never the pairs. Each pair counts at the first meeting only. Equal vectors are one
class first, so a vector that fills a third of the table is one row here.

Vectors link only within one label. Null labels, null ids, and vectors that are null, empty, zero or hold null
or non-finite components link with nothing; nor do vectors of different lengths. Repeated rows count as vectors
of their own, and rows that share an id are one node of the graph. A table without rows gives none.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, splittable
from momentloom.llm.graph import block_of, components, forest, whole_groups

TABLES = 6
PROBES = 8
SEED = 8
#: Vectors on one side of a comparison in a task.
BLOCK = 512
#: Linked pairs whose cells are compared at a time.
PAIRS = 20_000
#: Lattice spacing, in standard deviations of a coordinate of the difference of two vectors at the threshold.
SPACING = 4.8


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 lattice points nearest to the origin."""
    whole = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            whole.append(v)
    half = [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + half)


def _even_sum(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    error = x - near
    worst = np.abs(error).argmax(axis=1)
    rows = np.arange(len(x))
    odd = near.sum(axis=1) % 2 != 0
    near[rows, worst] += np.where(odd, np.where(error[rows, worst] >= 0, 1.0, -1.0), 0.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: whole coordinates of even sum, or the same moved by a half."""
    whole, half = _even_sum(x), _even_sum(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=8)
def directions(dimensions: int) -> np.ndarray:
    """``TABLES`` sets of eight directions; orthogonal to each other as far as the space has room."""
    rng = np.random.default_rng([SEED, dimensions])
    found: list[np.ndarray] = []
    while sum(f.shape[1] for f in found) < 8 * TABLES:
        found.append(np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0])
    return np.concatenate(found, axis=1)[:, : 8 * TABLES]


def _code(points: np.ndarray) -> np.ndarray:
    """One integer for each lattice point. Points that share it only cost comparisons."""
    doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    code = np.zeros(doubled.shape[:-1], dtype=np.uint64)
    for i in range(8):
        code = (code ^ doubled[..., i]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code.astype(np.int64)


def cells(unit: np.ndarray, threshold: float) -> np.ndarray:
    """Codes of shape (vectors, TABLES, 1 + PROBES): the home cell, then the probes."""
    n, d = unit.shape
    spacing = SPACING * np.sqrt(2 * (1 - threshold) / d)
    projected = (unit @ directions(d) / spacing).reshape(n, TABLES, 8)
    out = np.zeros((n, TABLES, 1 + PROBES), dtype=np.int64)
    near = minimal_vectors()
    for t in range(TABLES):
        x = projected[:, t]
        home = decode(x)
        # |x - home - m|^2 is least where m lies most along x - home, as all m have one length.
        order = np.argsort(-((x - home) @ near.T), axis=1, kind="stable")[:, :PROBES]
        out[:, t, 0] = _code(home)
        out[:, t, 1:] = _code(home[:, None, :] + near[order])
    return out


def _unit(vectors: pd.Series) -> np.ndarray:
    """Unit vectors in double precision, of vectors of one length."""
    v = np.array(vectors.tolist(), dtype=np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # so that no square is too large or too small
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _coded(threshold: float):
    def code(batches):
        for batch in batches:
            for _, part in batch.groupby(batch["vec"].map(len)):
                codes = cells(_unit(part["vec"]), threshold).reshape(len(part), -1)
                yield part.assign(codes=list(codes))

    return code


def _linked(unit: np.ndarray, part: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a block that are linked and met here first."""
    keys, home = part["key"].to_numpy(), part["home"].to_numpy()
    source, target = np.flatnonzero(part["source"].to_numpy()), np.flatnonzero(part["target"].to_numpy())
    s, t = np.nonzero(unit[source] @ unit[target].T >= threshold - 1e-9)
    a, b = source[s], target[t]
    fine = (keys[a] != keys[b]) & (~home[a] | (keys[a] < keys[b]))
    a, b = a[fine], b[fine]
    exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
    a, b = a[exact], b[exact]
    if not len(a):
        return a, b
    codes = np.stack(part["codes"].to_numpy()).reshape(len(part), TABLES, 1 + PROBES)
    now = int(part["tab"].iloc[0])
    mine = [_met_first(codes[a[i : i + PAIRS]], codes[b[i : i + PAIRS]], now, keys[a[i : i + PAIRS]] < keys[b[i : i + PAIRS]]) for i in range(0, len(a), PAIRS)]
    here = np.concatenate(mine)
    return a[here], b[here]


def _met_first(p: np.ndarray, q: np.ndarray, now: int, ahead: np.ndarray) -> np.ndarray:
    """Whether pairs of vectors with cells p and q met in no table before ``now``, and count in this cell of it.

    Two vectors that probe each other's homes meet in both cells; there the one ``ahead`` is the source.
    """
    same = p[:, :, 0] == q[:, :, 0]
    forth = (p[:, :, 1:] == q[:, :, :1]).any(axis=2)
    back = (q[:, :, 1:] == p[:, :, :1]).any(axis=2)
    first = (same | forth | back).argmax(axis=1) == now
    return first & (same[:, now] | ~(forth[:, now] & back[:, now]) | ahead)


def _compared(threshold: float):
    def compare(batches):
        for group in whole_groups(batches, ["grp", "tab", "cell", "i", "j"]):
            if not group["target"].any() or len(group) < 2:
                continue
            for _, part in group.groupby(group["vec"].map(len)):
                a, b = _linked(_unit(part["vec"]), part, threshold)
                if not len(a):
                    continue
                node, copies, n = part["node"].to_numpy(), part["copies"].to_numpy(), len(part)
                links = np.bincount(a, weights=copies[b], minlength=n) + np.bincount(b, weights=copies[a], minlength=n)
                some = np.flatnonzero(links)
                edges = np.array(forest(node[a], node[b]), dtype=np.int64).reshape(-1, 2)
                yield pd.DataFrame({
                    "a": np.concatenate([node[some], edges[:, 0]]),
                    "b": np.concatenate([node[some], edges[:, 1]]),
                    "key": np.concatenate([part["key"].to_numpy()[some], np.full(len(edges), "")]),
                    "links": np.concatenate([links[some], np.zeros(len(edges))]).astype(np.int64),
                })

    return compare


def near_vectors(df: DataFrame, vec_id: str, vector: str, label: str, threshold: float = 0.98, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row: links within a label at a cosine of ``threshold`` or more."""
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), F.col(label).alias("grp"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0.0)
    sound = F.coalesce(F.col("id").isNotNull() & F.col("grp").isNotNull() & finite, F.lit(False))
    # A label may hold commas; its digest has a fixed length and none.
    rows = rows.withColumn("key", F.when(sound, F.md5(F.concat_ws(",", F.md5(F.col("grp").cast("string")), F.col("vec").cast("array<string>")))))
    classes = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.first("vec").alias("vec"), F.xxhash64(F.first("grp")).alias("grp"))

    # Cells are computed once for each vector and go with it, so that all tasks agree on them to the last bit.
    coded = kept(classes.mapInPandas(_coded(threshold), "key string, node long, copies long, vec array<double>, grp long, codes array<long>"))
    placed = coded.select("grp", "node", "key", F.posexplode("codes").alias("at", "cell"))
    placed = placed.select("grp", F.floor(F.col("at") / (1 + PROBES)).cast("int").alias("tab"), "cell", (F.col("at") % (1 + PROBES) == 0).alias("home"), "node", "key")
    sizes = placed.groupBy("grp", "tab", "cell").agg(F.count("*").alias("m"), F.count_if("home").alias("h")).where("m > 1 and h > 0")
    sizes = sizes.select("grp", "tab", "cell", F.ceil(F.col("m") / block).alias("ni"), F.ceil(F.col("h") / block).alias("nj"))
    live = placed.join(splittable(sizes), ["grp", "tab", "cell"]).withColumns({"bi": block_of("key", F.col("ni"), "i"), "bj": block_of("key", F.col("nj"), "j")})
    # A source goes to every block of targets, a target to every block of sources; where both meet it is one row.
    places = F.transform(F.sequence(F.lit(0), F.col("nj") - 1), lambda j: F.struct(F.col("bi").alias("i"), j.alias("j")))
    homes = F.transform(F.sequence(F.lit(0), F.col("ni") - 1), lambda i: F.struct(i.alias("i"), F.col("bj").alias("j")))
    spots = F.explode(F.array_distinct(F.concat(places, F.when(F.col("home"), homes).otherwise(F.slice(places, 1, 0)))))
    live = live.withColumn("at", spots).select("grp", "tab", "cell", "at.i", "at.j", "home", "node", "key", (F.col("at.i") == F.col("bi")).alias("source"), (F.col("home") & (F.col("at.j") == F.col("bj"))).alias("target"))
    dealt = live.join(coded.select("key", "copies", "vec", "codes"), "key")
    by = ["grp", "tab", "cell", "i", "j"]
    found = dealt.repartition(*by).sortWithinPartitions(*by).mapInPandas(_compared(threshold), "a long, b long, key string, links long")

    found = kept(found)
    links = found.where("links > 0").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.where("links = 0").select("a", "b"))
    told = coded.select("key", "node", "copies").join(links, "key", "left").join(roots, "node", "left")
    told = told.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    out = rows.select("id", "key").join(told, "key", "left")
    component = F.coalesce("root", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
