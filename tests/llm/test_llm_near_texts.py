"""Near-duplicate texts against brute force."""

import random

import cases
import numpy as np
import pytest

from momentloom.llm import minhash, words
from momentloom.llm.graph import components


def brute(rows, threshold=0.8):
    sets = [set(words.shingles(t or "", 5).tolist()) for _, t in rows]
    links, root, pairs = [0] * len(rows), {i: i for i, _ in rows}, []
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                pairs.append((rows[i][0], rows[j][0]))
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return sorted(((r[0], root[r[0]], n) for r, n in zip(rows, links)), key=str)


def texts(n=120, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 120))] for _ in range(8)]
    out = []
    for i in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        out.append((i * 7 % 997, " ".join(t)))
    return out


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])
def test_links_and_classes_as_brute_force(spark, block):
    rows = texts() + [(r[0], r[1]) for r in cases.DOCS]
    df = cases.crowded(spark.createDataFrame(rows, "doc_id long, text string"))
    found = minhash.near_texts(df, "doc_id", "text", block=block).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found), key=str) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found if r["doc_id"] is not None)


def test_no_rows(spark):
    assert minhash.near_texts(cases.no_docs(spark), "doc_id", "text").collect() == []


def test_bands_reach_the_recall():
    bands, rows = minhash.plan_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= minhash.HASHES
    with pytest.raises(ValueError):
        minhash.plan_bands(0.01, 0.9999)


def test_common_items_in_slices():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, size=rng.integers(1, 4000))) for _ in range(9)]
    common = minhash.common_items(sets)
    for i in range(9):
        for j in range(9):
            if i != j:
                assert common[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(501, 540)] + [(7, 7), (3, 2), (2, 3), (None, 4)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(roots) == len(found)
    assert all(roots[i] == 100 for i in range(100, 161)) and all(roots[i] == 500 for i in range(500, 540))
    assert roots[3] == roots[2] == 2 and 7 not in roots and 4 not in roots
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
