"""Near-duplicate texts: a join on the Jaccard similarity of their word n-grams.

Texts become sets of hashed runs of ``size`` words. A MinHash signature of each set is cut into bands; texts
that share a band are candidates. Rows and bands follow from the threshold and the recall that a pair at the
threshold shall have (``plan_bands``). Candidates are verified on the full sets.

Texts with equal sets are one class, so any number of copies is one row. Classes that share bands, directly or
through others, form a cluster; a cluster of any size is cut into blocks, and pairs of blocks are compared in
tasks of bounded size. These give counts and spanning edges, never the pairs, so that every link counts and
none is written out.

A null text or one without words has an empty set and links with nothing, not even with another such text; a text
of fewer words than ``size`` is one run of all its words. Words ignore case. Rows with a null id link with
nothing. Repeated rows are documents of their own for ``n_links``; rows that share an id are one node of the graph.
Ties do not arise, as the least id names a class. Texts of any length are taken whole; a table without rows gives none.
"""

from __future__ import annotations

from hashlib import md5
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, splittable
from momentloom.llm.graph import block_of, components, forest, whole_groups
from momentloom.llm.words import mixed, shingles

SIZE = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Most hashes of a signature; more rows in a band mean fewer false candidates.
HASHES = 160
SEED = 5
#: Texts, and shingles, in a block.
BLOCK = 256
BLOCK_SHINGLES = 500_000


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which a pair at the threshold shares a band with the given probability."""
    best = None
    for rows in range(1, hashes + 1):
        bands = ceil(log(1 - recall) / log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows > hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this threshold and recall")
    return best


def signature(items: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band, from the least values of ``bands * rows`` hash functions over the set."""
    rng = np.random.default_rng(SEED)
    factor = rng.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(items), 2048):
        values = np.multiply.outer(factor, items[start : start + 2048]) + shift[:, None]
        least = np.minimum(least, values.min(axis=1))
    code = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for column in least.reshape(bands, rows).T:
        code = mixed(code * np.uint64(0x9E3779B97F4A7C15) ^ column)
    return code.astype(np.int64)


def _signed(size: int, bands: int, rows: int):
    def sign(batches):
        for batch in batches:
            sets = [shingles(t or "", size) for t in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"],
                "key": [md5(s.tobytes()).hexdigest() if len(s) else None for s in sets],
                "n": [len(s) for s in sets],
                "bands": [signature(s, bands, rows) if len(s) else None for s in sets],
            })

    return sign


def _with_sets(size: int):
    def add(batches):
        for batch in batches:
            sets = [shingles(t or "", size) for t in batch["text"]]
            right = np.array([len(s) > 0 and md5(s.tobytes()).hexdigest() == k for s, k in zip(sets, batch["key"])], dtype=bool)
            out = batch.drop(columns="text").assign(items=[s.astype(np.int64) for s in sets])
            yield out[right].drop_duplicates("key")  # an id may stand for several texts

    return add


def common_items(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of slices of the membership matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    out = np.zeros((len(sets), len(sets)))
    if not len(column):
        return out
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(256, (1 << 21) // len(sets))
    for start in range(0, int(column[-1]) + 1, step):
        low, high = np.searchsorted(column, [start, start + step])
        member = np.zeros((len(sets), step), dtype=np.float32)
        member[owner[low:high], column[low:high] - start] = 1.0
        out += member @ member.T
    return out


def _compared(threshold: float):
    def compare(batches):
        for group in whole_groups(batches, ["root", "i", "j"]):
            group = group.drop_duplicates("key")
            if len(group) < 2:
                continue
            sets = [np.asarray(s, dtype=np.int64) for s in group["items"]]
            sizes = np.array([len(s) for s in sets], dtype=np.float64)
            common = common_items(sets)
            similar = common / (sizes[:, None] + sizes[None, :] - common) >= threshold
            block = group["block"].to_numpy()
            if (block != block[0]).any() or group["i"].iloc[0] != group["j"].iloc[0]:
                similar &= block[:, None] != block[None, :]  # pairs within a block meet where i = j
            a, b = np.nonzero(np.triu(similar, 1))
            if not len(a):
                continue
            node, copies, n = group["node"].to_numpy(), group["copies"].to_numpy(), len(group)
            links = np.bincount(a, weights=copies[b], minlength=n) + np.bincount(b, weights=copies[a], minlength=n)
            some = np.flatnonzero(links)
            edges = np.array(forest(node[a], node[b]), dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({
                "a": np.concatenate([node[some], edges[:, 0]]),
                "b": np.concatenate([node[some], edges[:, 1]]),
                "key": np.concatenate([group["key"].to_numpy()[some], np.full(len(edges), "")]),
                "links": np.concatenate([links[some], np.zeros(len(edges))]).astype(np.int64),
            })

    return compare


def near_texts(df: DataFrame, doc_id: str, text: str, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, n_links, kept`` for each row.

    ``n_links`` counts the other documents at the threshold or above, copies included. ``class_id`` is the
    least id that links lead to, and ``kept`` marks the documents of that id: one for each class.
    """
    bands, rows = plan_bands(threshold, recall)
    docs = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = kept(docs.mapInPandas(_signed(size, bands, rows), "id long, key string, n long, bands array<long>"))
    linkable = signed.where("id is not null and key is not null")
    classes = kept(linkable.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")))

    # Classes that share a band point to the least of them; where that leads in the end names the cluster.
    buckets = classes.select("node", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").select("band", "head")
    heads = splittable(heads)
    clusters = components(buckets.join(heads, "band").select(F.col("node").alias("a"), F.col("head").alias("b")))
    members = classes.drop("bands").join(clusters, "node")
    sizes = members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    members = members.join(splittable(sizes), "root").withColumn("block", block_of("key", F.col("blocks"), "block"))
    texts = docs.join(members, docs["id"] == members["node"]).select("root", "node", "key", "copies", "blocks", "block", "text")
    fields = "root long, node long, key string, copies long, blocks long, block long, items array<long>"
    sets = texts.mapInPandas(_with_sets(size), fields)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = sets.withColumn("other", other).select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "key", "copies", "items")
    by = ["root", "i", "j"]
    found = kept(dealt.repartition(*by).sortWithinPartitions(*by).mapInPandas(_compared(threshold), "a long, b long, key string, links long"))

    links = found.where("links > 0").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.where("links = 0").select("a", "b"))
    told = classes.select("key", "node", "copies").join(links, "key", "left").join(roots, "node", "left")
    told = told.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    out = signed.select("id", F.when(F.col("id").isNotNull(), F.col("key")).alias("key")).join(told, "key", "left")
    head = F.coalesce("root", "id")
    return out.select(F.col("id").alias("doc_id"), head.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.col("id") == head, F.lit(True)).alias("kept"))
