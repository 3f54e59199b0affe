"""Lattice decoding and near-duplicate vectors against brute force."""

import numpy as np
import pytest

from momentloom.llm import lattice

FIELDS = "vec_id long, embedding array<float>, label int, key string, node int"


def brute(rows, threshold=0.98):
    def sound(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    links = [0] * len(rows)
    root = {r[0]: r[0] for r in rows}
    pairs = []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                u, v = (np.float32(x[1]).astype(float) for x in (a, b))
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((a[0], b[0]))
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return sorted(((r[0], n, root[r[0]]) for r, n in zip(rows, links)), key=str)


def random_rows(n=160, d=64, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    out = []
    for i in range(n):
        c = centres[rng.integers(0, 6)]
        out.append((i * 3 % 499, (c + rng.normal(size=d) * rng.choice([0.02, 0.1, 0.14, 1.0])).tolist(), int(rng.integers(0, 2)), "x", 1))
    return out


ODD = [
    (900, None, 1, "x", 1), (901, [], 1, "x", 1), (902, [0.0] * 64, 1, "x", 1), (903, [float("nan")] + [1.0] * 63, 1, "x", 1),
    (904, [float("inf")] + [1.0] * 63, 1, "x", 1), (905, [None] + [1.0] * 63, 1, "x", 1), (906, [1.0] * 64, None, "x", 1),
    (907, [1.0] * 64, None, "x", 1), (None, [1.0] * 64, 1, "x", 1), (908, [1.0] * 64, 1, "x", 1), (909, [2.0] * 64, 1, "x", 1),
    (910, [1.0] * 64, 1, "x", 1), (910, [1.0] * 64, 1, "x", 1), (911, [1.0] * 8, 1, "x", 1), (912, [1e-30] * 64, 1, "x", 1), (913, [1e30] * 64, 1, "x", 1),
]


@pytest.mark.parametrize("block", [lattice.BLOCK, 5])
def test_links_and_components_as_brute_force(spark, block):
    rows = random_rows() + ODD
    df = spark.createDataFrame(rows, FIELDS)
    found = lattice.near_vectors(df, "vec_id", "embedding", "label", block=block).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found if r["vec_id"] is not None)


def test_other_lengths_and_no_rows(spark):
    rows = random_rows(40, d=3) + random_rows(40, d=20, seed=5)
    found = lattice.near_vectors(spark.createDataFrame(rows, FIELDS), "vec_id", "embedding", "label").collect()
    assert sorted(r["n_links"] for r in found) == sorted(n for _, n, _ in brute(rows))
    assert lattice.near_vectors(spark.createDataFrame([], FIELDS), "vec_id", "embedding", "label").collect() == []


def test_decoded_points_are_nearest():
    x = np.random.default_rng(1).normal(size=(400, 8)) * 2
    home = lattice.decode(x)
    assert np.allclose((home * 2) % 1, 0) and np.all(home.sum(axis=1) % 2 == 0)
    distance = ((x - home) ** 2).sum(axis=1)
    around = home[:, None, :] + lattice.minimal_vectors()
    assert np.all(distance[:, None] <= ((x[:, None, :] - around) ** 2).sum(axis=2) + 1e-9)


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * o / np.linalg.norm(o, axis=1, keepdims=True)
    p, q = lattice.cells(a, 0.98), lattice.cells(b, 0.98)
    met = (p[:, :, :1] == q).any(axis=2) | (q[:, :, :1] == p).any(axis=2)
    assert met.mean() > 0.92 and met.any(axis=1).all()


def test_labels_with_commas_stay_apart(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [2.0], "a,1.0"), (3, [2.0], "a,1.0")]
    found = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), "vec_id", "embedding", "label").collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(1, 0, 1), (2, 1, 2), (3, 1, 2)]
