"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from momentloom.llm import queries, variants


def counted(docs):
    counts = Counter()
    for d, t in docs:
        for m in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in m)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute(counts):
    """Near words share a word with one place blotted out, or one is the other without a letter."""
    holes, near = {}, {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def words(n=1500, seed=5):
    rng, out = random.Random(seed), {}
    for _ in range(n):
        w = "".join(rng.choice("abcé") for _ in range(rng.choice([1, 2, 5, 6, 7, 7, 7])))
        out[w] = rng.choice([1, 1, 2, 5, 5, 30, 200])
    return out | {"x" * 200: 3, "x" * 199 + "y": 20, "x" * 201: 4, "ÿÿÿ": 1}


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize(("cell", "part", "at_once"), [(variants.CELL, variants.PART, variants.AT_ONCE), (20, 8, 2000)])
def test_forms_as_all_pairs(spark, monkeypatch, cell, part, at_once):
    for name, value in (("CELL", cell), ("PART", part), ("AT_ONCE", at_once)):
        monkeypatch.setattr(variants, name, value)
    counts = words()
    df = cases.crowded(spark.createDataFrame([*counts.items(), (None, 7), ("", 7)], "word string, n long").withColumnRenamed("n", "times"))
    assert rows(variants.group_variants(df.drop("n"), "word", "times")) == brute(counts)


def test_cells_reached_hold_all_near_vectors():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (400, len(variants.LETTERS))).astype(np.int8)
    counts[:, 4:] = 0
    tree = variants.upper_tree(counts, 10, 0)
    cell = np.full(len(counts), -1)
    for c, found in variants.reached(tree, counts, 0, 0):
        assert (cell[found] == -1).all()
        cell[found] = c
    assert (cell >= 0).all() and len(set(cell.tolist())) > 10
    for gains, losses in ((1, 1), (1, 0), (0, 1)):
        seen = {(int(r), c) for c, found in variants.reached(tree, counts, gains, losses) for r in found}
        change = counts[None].astype(int) - counts[:, None]
        near = (np.maximum(change, 0).sum(axis=2) <= gains) & (np.maximum(-change, 0).sum(axis=2) <= losses)
        assert all((int(i), int(cell[j])) in seen for i, j in zip(*np.nonzero(near)))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_as_brute_force(spark, folder):
    folder = f"/root/testdata/{folder}"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = rows(queries.op11_variants(spark, folder))
    assert found == brute(counted(docs)) and any(r[1] for r in found)


def test_odd_and_no_rows(spark):
    docs = cases.crowded(cases.docs(spark))
    found = variants.group_variants(variants.vocabulary(docs, "doc_id", "text"))
    assert rows(found) == brute(counted([(r[0], r[1]) for r in cases.DOCS]))
    assert variants.group_variants(variants.vocabulary(cases.no_docs(spark), "doc_id", "text")).collect() == []
