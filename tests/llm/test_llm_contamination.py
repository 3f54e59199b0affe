"""Spaced seeds and overlaps against brute force."""

import random
from itertools import combinations

import cases
import numpy as np
import pytest

from momentloom.llm import spaced, words


def least_substitutions(length):
    """The fewest substitutions in a stretch with equal ends that no mask hits, by the last words of every prefix."""
    span = spaced.FULL
    masks = [int(m, 2) for m in spaced.MASKS]
    hit = np.array([[(state & m) == m for m in masks] for state in range(1 << span)])
    fits = lambda n: hit[:, [n >= len(m) for m in spaced.MASKS]].any(axis=1)
    states = np.arange(1 << span)
    least = np.full(1 << span, 10**6)
    least[1] = 0
    for n in range(2, length + 1):
        longer = np.full(1 << span, 10**6)
        for equal in (0, 1):
            np.minimum.at(longer, ((states << 1) | equal) & ((1 << span) - 1), least + 1 - equal)
        longer[fits(n)] = 10**6
        least = longer
    return int(least[states % 2 == 1].min())


def test_masks_hit_every_stretch_with_substitutions():
    for length, wrong in ((13, 2), (15, 3)):
        for places in combinations(range(length), wrong):
            stretch = "".join("0" if i in places else "1" for i in range(length))
            assert any(all(stretch[o + i] == "1" for i in spaced._offsets(m)) for m in spaced.MASKS for o in range(length - len(m) + 1))
    for length in range(spaced.LEAST, 61):
        assert least_substitutions(length) > int((1 - spaced.IDENTITY) * length + 1e-9)


def brute_overlap(item, doc, shift, least, identity):
    best = (0, 0, 0)
    for i in range(len(item)):
        for j in range(i + least - 1, len(item)):
            if 0 <= i + shift and j + shift < len(doc) and item[i] == doc[i + shift] and item[j] == doc[j + shift]:
                equal = sum(item[k] == doc[k + shift] for k in range(i, j + 1))
                if equal >= identity * (j - i + 1) - 1e-9 and (j - i + 1) > best[1]:
                    best = (i, j - i + 1, equal)
    return best


def test_overlaps_are_the_longest():
    rng = random.Random(8)
    for _ in range(400):
        item = np.array([rng.randint(0, 3) for _ in range(rng.randint(3, 24))])
        doc = np.array([rng.randint(0, 3) for _ in range(rng.randint(3, 30))])
        shift = rng.randint(-10, 12)
        least = rng.randint(2, 6)
        assert spaced.overlap(item, doc, shift, least, 0.8)[1] == brute_overlap(item, doc, shift, least, 0.8)[1]


def brute(docs, items, least=spaced.LEAST, identity=spaced.IDENTITY):
    out = {}
    for d, text in docs:
        w = words.word_hashes(text or "")
        for i, t in items:
            v = words.word_hashes(t or "")
            if len(v) >= spaced.SHORTEST:
                best = max((spaced.overlap(v, w, s, *spaced.demand(len(v), least, identity))[1:] for s in range(-len(v), len(w))), default=(0, 0))
                if best[0]:
                    out[(d, t)] = best
    return out


def tables(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "and"] * 40
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, some(rng.randint(3, 50))) for i in range(30)]
    docs = []
    for d in range(120):
        text = some(rng.randint(0, 60))
        if rng.random() < 0.6:
            _, item = rng.choice(items)
            a = rng.randint(0, len(item) // 2)
            part = list(item[a : a + rng.randint(5, 50)])
            for _ in range(rng.randint(0, len(part) // 6)):
                part[rng.randrange(len(part))] = "changed"
            text += part + some(rng.randint(0, 60))
        docs.append((d, " ".join(text).capitalize()))
    return docs, [(i, " ".join(t)) for i, t in items]


@pytest.mark.parametrize("bits", [spaced.FILTER_BITS, 15])  # a full filter only means more work
def test_documents_and_items_as_brute_force(spark, bits):
    docs, items = tables()
    docs += [(r[0], r[1]) for r in cases.DOCS if r[0] not in (2, 7)] + [(200, None), (201, items[3][1]), (201, items[3][1]), (None, items[4][1]), (202, "x " * 5000 + items[5][1])]
    items += [(100, None), (101, ""), (102, "too short"), (103, items[3][1]), (None, items[6][1]), (103, items[3][1])]
    df = cases.crowded(spark.createDataFrame(docs, "doc_id long, text string"))
    test = cases.crowded(spark.createDataFrame(items, "item_id long, text string"))
    found = spaced.overlaps(df, "doc_id", "text", test, "item_id", "text", filter_bits=bits).collect()
    by_id = [(r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in found]
    want = brute(docs, items)
    ids = {t: sorted({i for i, x in items if x == t}, key=str) for _, t in items}
    assert sorted(by_id, key=str) == sorted(((d, i, n, e) for (d, t), (n, e) in want.items() for i in ids[t]), key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, cases.DOCS[0][1])], "item_id long, text string")
    assert spaced.overlaps(cases.docs(spark), "doc_id", "text", none, "item_id", "text").collect() == []
    assert spaced.overlaps(cases.no_docs(spark), "doc_id", "text", some, "item_id", "text").collect() == []
    assert {r["doc_id"] for r in spaced.overlaps(cases.docs(spark), "doc_id", "text", some, "item_id", "text").collect()} == {1, 2}


def test_short_items_are_found_whole(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(n, " ".join(word() for _ in range(n))) for n in range(1, 14)]
    docs = [(n, f"{word()} {word()}, {t.upper()}! {word()}") for n, t in items]
    docs += [(100 + n, " ".join(t.split()[:-1]) + " " + word()) for n, t in items]  # the last word is another
    docs += [(200 + n, t) for n, t in items] + [(300, ""), (301, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    test = spark.createDataFrame([*items, (50, ""), (51, None), (52, "!?")], "item_id long, text string")
    found = lambda **more: sorted((r["doc_id"], r["item_id"], r["n_words"]) for r in spaced.overlaps(df, "doc_id", "text", test, "item_id", "text", **more).collect())
    assert found() == sorted((m + n, n, n) for n, _ in items for m in (0, 200))
    assert found(shortest=8) == sorted((m + n, n, n) for n, _ in items if n >= 8 for m in (0, 200))
