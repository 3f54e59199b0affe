"""BPE against the tokenizers library."""

import random
from hashlib import sha256

import cases
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from momentloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
POOL = "  \t\n\r\x0b\x1c\x85\xa0 ​'stremvld<|endoftext|>aAé中文字١२😀ſK½²ⅷ́_-!?#0123456789"


def library(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_as_the_library():
    rng = random.Random(5)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    texts += ["a" * 3000, "中" * 2000, " " * 3000, "!" * 2000, "", "<|endoftext|>a <|endoftext|>", "don't we'll I'M"]
    mine = bpe.Tokenizer(PATH)
    want = library(texts)
    assert [x.tolist() for x in mine.encode(texts)] == want
    for ids in want:
        part = ids[len(ids) // 3 :]  # also ids that begin within a character
        assert mine.decode(np.array(part, dtype=int)) == LIBRARY.decode(part, skip_special_tokens=False)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    mine = bpe.Tokenizer(PATH)
    texts = ["some words here", "other words there", "some words here"]
    assert [x.tolist() for t in texts for x in mine.encode([t])] == library(texts)


def test_columns_take_every_kind_of_row(spark):
    rows = cases.crowded(cases.docs(spark)).withColumn("back", bpe.encode(F.col("text"), PATH)).withColumn("again", bpe.decode(F.col("back"), PATH)).collect()
    for r in rows:
        assert (r["back"] is None) == (r["text"] is None)
        assert r["again"] == r["text"]
        if r["text"] is not None:
            assert r["back"] == library([r["text"]])[0]
    assert cases.no_docs(spark).select(bpe.encode(F.col("text"), PATH)).collect() == []


def test_query_digests(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op5_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library([texts[r["doc_id"]]])[0]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
