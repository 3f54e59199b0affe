"""Registered queries against their SQL, and the stages of the pipeline against brute force."""

import sys
from pathlib import Path
from types import SimpleNamespace

import cases
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "scripts")]

import corpus_pipeline  # noqa: E402
from check import compare, connect  # noqa: E402
from test_llm_contamination import brute as brute_overlaps  # noqa: E402
from test_llm_near_texts import brute as brute_classes  # noqa: E402
from test_llm_secrets import brute as brute_secrets  # noqa: E402

import __spark_entry__ as entry_file  # noqa: E402
from momentloom.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_sql(spark, name):
    outcome = compare(spark, connect(FOLDER), SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name]), FOLDER)
    assert outcome.startswith("ok"), outcome


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_file.queries())
    assert len(corpus_pipeline.STAGES) == 5


def test_decontamination_query_as_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    texts = dict(items)
    found = {(r["doc_id"], texts[r["item_id"]]): (r["n_words"], r["n_equal"]) for r in queries.op10_spaced_seeds(spark, folder).collect()}
    assert found and found == brute_overlaps(docs, items)


def test_stages_one_after_another(spark):
    folder = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(cases.docs(spark).where("doc_id > 2 or doc_id is null").selectExpr("doc_id + 1000000 as doc_id", "text", "lang", "source", "n_chars"))
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)

    known = stages["language"](spark, docs, folder)
    assert known.columns == docs.columns
    assert rows(known) == [r for r in rows(docs) if r[1] and any(map(str.isalpha, r[1]))]

    single = stages["near_duplicates"](spark, known, folder)
    gone = {d for d, c, _ in brute_classes(rows(known)) if d != c}
    assert rows(single) == [r for r in rows(known) if r[0] not in gone]

    clean = stages["decontamination"](spark, single, folder)
    leaks = {d for d, _ in brute_overlaps(rows(single), items)}
    assert leaks and rows(clean) == [r for r in rows(single) if r[0] not in leaks]

    safe = stages["secrets"](spark, clean, folder)
    assert [r[0] for r in rows(safe)] == [r[0] for r in rows(clean)] and not any(brute_secrets(t) for _, t in rows(safe))
    for (_, before), (_, after) in zip(rows(clean), rows(safe)):
        assert (before == after) == (not brute_secrets(before))

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = stages["tokens"](spark, safe, folder).collect()
    ids = {r["doc_id"]: r["ids"] for r in last}
    assert len(last) == safe.count()
    assert all(ids[d] == library.encode(t, add_special_tokens=False).ids for d, t in rows(safe))


def test_stages_on_odd_and_empty_tables(spark):
    for df in (cases.crowded(cases.docs(spark)), cases.no_docs(spark)):
        docs = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            assert docs.columns == df.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()
        assert docs.count() == 0 or sorted((r["doc_id"] for r in docs.collect()), key=str) == [1, 6, 7, 8, None]


def test_run_writes_and_rereads_each_stage(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and found.count() > 0


@pytest.mark.parametrize("stage", ["language", "decontamination", "secret_spans"])
def test_stages_leave_columns_of_any_name_alone(spark, stage):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = docs
    for name in ("_base", "_spans", "_key", "_language", "_Familiar"):
        more = more.withColumn(name, F.lit("x"))
    plain, found = (getattr(corpus_pipeline, stage)(spark, rows, folder) for rows in (docs, more))
    assert found.columns == more.columns and {r["_spans"] for r in found.select("_spans").collect()} == {"x"}
    assert sorted(map(str, plain.collect())) == sorted(map(str, found.select(*docs.columns).collect()))
