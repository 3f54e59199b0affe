"""Repeated byte strings against brute force."""

import random
from collections import Counter
from hashlib import sha256

import cases
import pandas as pd
import pytest
from pyspark.sql import functions as F

from momentloom.llm import queries, repeats


def brute(texts, length):
    """Maximal runs of covered bytes of each text."""
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = []
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append([tuple(s) for s in spans])
    return out


def outside(data, spans):
    ends = [0, *[x for s in spans for x in s], len(data)]
    return b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))


def passages(n=60, seed=4):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(10, 120))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh €") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 5))]
        out.append("".join(parts))
    return [*out, "a" * 300, "ab" * 90, "abc" * 40 + "x" + "abc" * 40, out[0], out[0], "", "x"]


@pytest.mark.parametrize("length", [1, 2, 5, 32])
def test_spans_of_one_batch_as_brute_force(length):
    texts = [t.encode() for t in passages()]
    assert [list(s) for s in repeats.repeated_spans(texts, length)] == brute(texts, length)


@pytest.mark.parametrize(("length", "group"), [(32, repeats.GROUP_BYTES), (32, 150), (7, 30)])
def test_spans_as_brute_force(spark, monkeypatch, length, group):
    """Groups beyond the bound of a task are cut by longer grains; the spans stay the same."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", group)
    rows = list(enumerate(passages())) + [(None, "abc" * 30), (None, None), (3, "abc" * 30), (3, "abc" * 30)]
    df = cases.crowded(spark.createDataFrame(rows, "doc_id long, text string"))
    found = repeats.mark_repeats(df, "doc_id", "text", length).withColumn("rest", repeats.without_spans(F.col("bytes"), F.col("spans"))).collect()
    texts = [(t or "").encode() for _, t in rows]
    wanted = brute(texts, length)
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], bytes(r["bytes"]), [tuple(s) for s in r["spans"]]) for r in found), key=key) == sorted(((d, t, s) for (d, _), t, s in zip(rows, texts, wanted)), key=key)
    assert all(bytes(r["rest"]) == outside(bytes(r["bytes"]), r["spans"]) for r in found)


def test_query_as_brute_force(spark):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    wanted = []
    for (d, t), spans in zip(docs, brute([t for _, t in docs], 400)):
        wanted.append((d, len(t), sum(b - a for a, b in spans), len(spans), sha256(outside(t, spans)).hexdigest()))
    found = sorted(tuple(r) for r in queries.op12_repeats(spark, "/root/testdata/sf0.001").collect())
    assert found == sorted(wanted) and any(w[2] for w in wanted)


def test_no_rows(spark):
    assert repeats.mark_repeats(cases.no_docs(spark), "doc_id", "text").collect() == []


def test_copies_are_compared_once(monkeypatch):
    """A text with copies is repeated whole; it goes through the transform once, for the others of its group."""
    seen = []
    spans = repeats.repeated_spans
    monkeypatch.setattr(repeats, "repeated_spans", lambda texts, length: seen.extend(texts) or spans(texts, length))
    rows = pd.DataFrame({"code": [1, 1, 2], "digest": [1, 2, 3], "weight": [5, 1, 1], "bytes": [b"xabcdefgx", b"yabcdefgy", b"z" * 9]})
    found = pd.concat(list(repeats._compared(7)([rows])))
    assert sorted(seen) == sorted(rows["bytes"])
    assert [(r.code, r.digest, r.spans) for r in found.itertuples()] == [(1, 2, [{"low": 1, "high": 8}]), (2, 3, [{"low": 0, "high": 9}])]


def test_groups_of_copies_alone_need_no_transform(spark, monkeypatch):
    def none(length):
        def run(batches):
            for batch in batches:
                assert not len(batch)
                yield pd.DataFrame({"code": [], "digest": [], "spans": []})

        return run

    monkeypatch.setattr(repeats, "_compared", none)
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(500))
    df = spark.createDataFrame([(i, t) for i, t in enumerate([text] * 4 + ["".join(rng.choice("abcdefgh") for _ in range(500))])], "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in repeats.mark_repeats(df, "doc_id", "text", 50).collect()}
    assert found == {0: [(0, 500)], 1: [(0, 500)], 2: [(0, 500)], 3: [(0, 500)], 4: []}
