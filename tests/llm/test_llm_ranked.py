"""Ranked search against scores of all documents."""

import random
from collections import Counter

import cases
import pytest

from momentloom.llm import ranked


def brute(docs, items, k):
    texts = [(d, ranked.terms(t)) for d, t in docs]
    texts = [(d, t) for d, t in texts if t]
    n_docs, n_all = len(texts), sum(len(t) for _, t in texts)
    df = Counter(x for _, t in texts for x in set(t))
    out = []
    for key, query in set(items):
        scores = []
        for d, t in texts:
            tf, m = Counter(t), ranked.damping(len(t), n_docs, n_all)
            score = sum(ranked.weight(n_docs, df[q]) * ranked.part(tf[q], m) for q in ranked.terms(query) if tf[q])
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(key, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def corpus(n=300, seed=2):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i * 11 % 1999, " ".join(rng.choice(words) for _ in range(rng.choice([3, 20, 200])))) for i in range(n)]
    docs += docs[:25] + [(5000 + i, docs[7][1]) for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(30)]
    return docs, items + [(30, None), (31, ""), (32, "!!!"), (33, "unseenterm"), (34, docs[7][1]), (None, "w1 w2"), (0, items[0][1]), (35, "The FOX fox über")]


@pytest.mark.parametrize(("at_once", "rows", "keys"), [(512, 1024, 500_000), (7, 10, 0)])
def test_ranks_as_brute_force(spark, monkeypatch, at_once, rows, keys):
    monkeypatch.setattr(ranked, "ITEMS_AT_ONCE", at_once)
    monkeypatch.setattr(ranked, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ranked, "BROADCAST_KEYS", keys)
    docs, items = corpus()
    docs += [(r[0], r[1]) for r in cases.DOCS]
    df = cases.crowded(spark.createDataFrame(docs, "doc_id long, text string"))
    queries = cases.crowded(spark.createDataFrame(items, "item_id long, text string"))
    found = ranked.search(df, "doc_id", "text", queries, "item_id", "text", 10).collect()
    wanted = brute(docs, [x for x in items if x[1]], 10)
    assert sorted((tuple(r) for r in found), key=str) == wanted and len(wanted) > 200


def test_terms():
    assert ranked.terms("Ab-c_9 ÀÉ\x7fz x") == ["ab".encode(), b"c", b"9", "ÀÉ".encode(), "z x".encode()]
    assert ranked.terms(None) == ranked.terms("") == ranked.terms(" .,") == []


def test_no_rows(spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked.search(cases.no_docs(spark), "doc_id", "text", items, "item_id", "text").collect() == []
    assert ranked.search(cases.docs(spark), "doc_id", "text", items.limit(0), "item_id", "text").collect() == []
