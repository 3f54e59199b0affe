"""Language, quality and toxicity: accuracy on documents held out from learning, and odd rows."""

import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from momentloom.llm import langid, quality, queries, toxicity
from momentloom.llm.common import held_out

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def truth(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return {r["doc_id"]: r for r in docs.join(labels, "doc_id", "left").select("doc_id", "lang", "text", "quality", "toxic").collect()}


def scored(rows, truth):
    rows = rows.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    return [(r, truth[r["doc_id"]]) for r in rows if r["held_out"]]


def test_language_of_held_out_documents(spark, truth):
    rows = scored(queries.op6_language(spark, FOLDER), truth)
    assert np.mean([r["lang_pred"] == t["lang"] for r, t in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r, _ in rows)


def test_quality_of_held_out_documents(spark, truth):
    rows = [(r, t["quality"]) for r, t in scored(queries.op7_quality(spark, FOLDER), truth) if t["quality"] is not None]
    assert np.mean([r["predicted"] == y for r, y in rows]) > 0.95
    assert np.mean([r["predicted"] == 0 for r, y in rows if y == 0]) > 0.85
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r, _ in rows)


def test_toxicity_of_held_out_documents(spark, truth):
    rows = [(r, t["toxic"]) for r, t in scored(queries.op9_toxicity(spark, FOLDER), truth) if t["toxic"] is not None]
    assert np.mean([r["toxic"] for r, y in rows if y == 1]) > 0.85
    assert np.mean([r["toxic"] for r, y in rows if y == 0]) < 0.03
    assert all(0 <= r["severity"] <= toxicity.GRADES - 1 for r, _ in rows)


def test_language_of_odd_rows(spark):
    df = cases.crowded(cases.docs(spark))
    model = langid.fit(df, "text", "lang", "doc_id")
    assert model.languages == ("en", "fr")  # the German row has no id
    found = df.withColumn("_p", langid.predict(F.col("text"), model)).collect()
    for r in found:
        unknown = not r["text"] or not any(map(str.isalpha, r["text"]))
        assert (r["_p"]["lang"] == "und") == unknown and 0 <= r["_p"]["score"] <= 1
    nothing = langid.fit(cases.no_docs(spark), "text", "lang", "doc_id")
    assert {r["p"]["lang"] for r in df.select(langid.predict(F.col("text"), nothing).alias("p")).collect()} == {"und"}


def test_texts_in_languages_that_were_not_learned(spark, truth):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = langid.fit_counts(docs.where(~held_out("doc_id")), "text", "lang", "doc_id")
    rng = np.random.default_rng(4)
    scripts = [np.arange(0x3B1, 0x3CA), np.arange(0x430, 0x450), np.arange(0x4E00, 0x5000), np.arange(0xE01, 0xE2F)]
    other = [" ".join("".join(map(chr, rng.choice(letters, rng.integers(1, 9)))) for _ in range(n)) for letters in scripts for n in (1, 2, 5, 20, 200) for _ in range(20)]
    other += ["Nopea ruskea kettu hyppää laiskan koiran yli", "Gyors barna róka átugrik a lusta kutyán, aztán hazamegy a sötét erdőn keresztül"]
    assert not any(langid.is_familiar(t, counts) for t in [*other, None, "", "123 !"])
    held = [r["text"] for d, r in truth.items() if zlib.crc32(str(d).encode()) % 4 == 2 and r["text"]]
    words = [w for t in held[:500] for w in t.split()[:3] if w.strip(".,").isalpha()]
    assert np.mean([langid.is_familiar(w, counts) for w in words]) > 0.99
    assert np.mean([langid.is_familiar(t, counts) for t in held]) > 0.998
    found = docs.limit(3).select(langid.familiar(F.col("text"), counts).alias("a"), langid.familiar(F.col("text"), None).alias("b")).collect()
    assert all(r["a"] and not r["b"] for r in found)


def test_profile_vectors_by_definition():
    """One text's vector against the definition: rotate, multiply, add."""
    text = "Ab, cab! É中"
    letters = [32, *map(ord, "ab"), 32, *map(ord, "cab"), 32, ord("é"), ord("中"), 32]
    want = np.zeros(langid.DIMENSIONS)
    for i in range(len(letters) - 2):
        want += np.prod([np.roll(langid._letter_vector(c), k).astype(float) for k, c in enumerate(letters[i : i + 3])], axis=0)
    assert np.allclose(langid.vectors(["", text, "x" * 3])[1], want)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("rows", [[], [(1, 1, 1, "x"), (2, 1, 1, "x")], [(1, 1, 0, "x"), (6, 0, 1, "x"), (7, None, None, "x"), (None, 0, 1, "x"), (99, 0, 0, "x"), (1, 1, 0, "x")]])
def test_classifiers_on_odd_rows(spark, rows):
    labels = labels_of(spark, rows)
    for df in (cases.crowded(cases.docs(spark)), cases.no_docs(spark)):
        good = quality.fit(df, "doc_id", "text", labels, "doc_id", "quality")
        bad = toxicity.fit(df, "doc_id", "text", labels, "doc_id", "toxic")
        found = df.select(quality.score(F.col("text"), good).alias("q"), toxicity.severity(F.col("text"), bad).alias("t")).collect()
        assert len(found) == df.count()
        assert all(0 <= r["q"] <= 1 and 0 <= r["t"]["severity"] <= toxicity.GRADES - 1 for r in found)


def test_ordinal_fit_recovers_a_known_model():
    rng = np.random.default_rng(4)
    n, truth = 6000, np.array([2.0, -1.0, 0.5])
    x = (rng.random((n, 3)) < 0.5).astype(float)
    noise = np.log(1 / rng.random(n) - 1)
    grade = np.searchsorted(np.array([0.0, 1.5]), x @ truth + noise)
    rows, columns = np.nonzero(x)
    w, cuts = toxicity.ordinal(rows, columns, x[rows, columns], grade, 3, 3)
    assert np.allclose(w, truth, atol=0.25) and cuts[0] < cuts[1] and abs(cuts[1] - cuts[0] - 1.5) < 0.25


def test_held_out_folds(spark):
    rows = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "i long").select("i", held_out("i").alias("h")).collect()
    assert all(r["h"] == (r["i"] is not None and zlib.crc32(str(r["i"]).encode()) % 4 == 2) for r in rows)
